"""SQL text or file into a table, with write and create dispositions."""

from datetime import date

import pytest

from eventlake.operators import tables as TB
from eventlake.operators import typed as TY
from eventlake.plans.registry import SQL_DIR
from eventlake.sources import fixture as X
from scales import SF_SMALL


def test_sql_file_with_parameters_into_table(spark):
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL))
    args = {"start_date": date(2024, 1, 10), "end_date": date(2024, 1, 12)}
    df, summary = TB.run_sql(spark, "NEWEST_IN_RANGE.SQL".lower(), args=args, base_dir=str(SQL_DIR),
                             destination="ota.deduped_range", typed=typed)
    assert summary["rows"] == 131 and df.count() == 131
    _, again = TB.run_sql(spark, "newest_in_range.sql", args=args, base_dir=str(SQL_DIR),
                          destination="ota.deduped_range", typed=typed)
    assert spark.table("ota.deduped_range").count() == 262  # append is the default
    TB.run_sql(spark, "newest_in_range.sql", args=args, base_dir=str(SQL_DIR),
               destination="ota.deduped_range", write_disposition=TB.WRITE_TRUNCATE, typed=typed)
    assert spark.table("ota.deduped_range").count() == 131
    with pytest.raises(ValueError, match="not empty"):
        TB.run_sql(spark, "SELECT 1 AS x", destination="ota.deduped_range", write_disposition=TB.WRITE_EMPTY)


def test_sql_identifier_parameter_and_errors(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ota")
    spark.range(5).write.mode("overwrite").saveAsTable("ota.numbers")
    df, _ = TB.run_sql(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE id >= :lo",
                       args={"t": "ota.numbers", "lo": 2})
    assert df.first()["n"] == 3
    with pytest.raises(FileNotFoundError):
        TB.run_sql(spark, "missing.sql", base_dir=str(SQL_DIR))
    with pytest.raises(ValueError, match="does not exist"):
        TB.run_sql(spark, "SELECT 1 AS x", destination="ota.nowhere", create_disposition=TB.CREATE_NEVER)


def test_create_table_if_absent(spark, folder):
    TB.ensure_table(spark, "ota.events_typed", str(folder / "typed"))
    TB.ensure_table(spark, "ota.events_typed", str(folder / "typed"))
    cols = [f.name for f in spark.table("ota.events_typed").schema.fields]
    assert cols[-1] == "source_day" and len(cols) == 32


def test_catalog_table_sees_path_writes(spark, folder):
    from eventlake.operators import dedupe as D

    location = str(folder / "deduped")
    TB.ensure_table(spark, "ota.events_deduped", location)
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL))
    TB.write_refresh(D.dedupe_full(typed), location)
    TB.sync_table(spark, "ota.events_deduped")
    assert spark.table("ota.events_deduped").count() == 1020
    TB.write_replace_range(D.dedupe_range(typed, "2024-01-10", "2024-01-12"), location, "2024-01-10", "2024-01-12")
    TB.sync_table(spark, "ota.events_deduped")
    n = spark.sql("SELECT count(*) FROM ota.events_deduped WHERE source_day BETWEEN DATE'2024-01-10' AND DATE'2024-01-12'")
    assert n.first()[0] == 131
