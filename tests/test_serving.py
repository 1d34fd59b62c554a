"""Cursor slices, capped chunks and text timestamps."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from eventlake.operators import serve as SV
from eventlake.sources import landing as L


def times(spark, values):
    return spark.createDataFrame([(datetime.fromisoformat(v),) for v in values], "timestamp timestamp")


def test_slice_strict_inclusive_and_lookback(spark):
    df = times(spark, ["2024-01-10T00:00:00+00:00", "2024-01-10T00:00:01+00:00", "2024-01-09T23:00:00+00:00"])
    strict = SV.cursor_start(param="2024-01-10T00:00:00Z")
    assert SV.after_cursor(df, strict).count() == 1
    backfill = SV.cursor_start(override="2024-01-10")
    assert SV.after_cursor(df, backfill).count() == 2
    assert SV.after_cursor(df, strict, lookback=timedelta(hours=2)).count() == 3
    assert SV.after_cursor(df.union(spark.createDataFrame([(None,)], "timestamp timestamp")), SV.cursor_start()).count() == 3


def test_chunk_ends_on_a_whole_timestamp(spark):
    ts = ["2024-01-10T00:00:01+00:00"] * 2 + ["2024-01-10T00:00:02+00:00"] * 3 + ["2024-01-10T00:00:03+00:00"]
    df = times(spark, ts)
    cursor = SV.cursor_start(param="2024-01-10T00:00:00Z")
    assert SV.first_chunk(df, cursor, 3).count() == 5  # the three rows at :02 stay together
    assert SV.first_chunk(df, cursor, 2).count() == 2
    got = SV.advance(SV.first_chunk(df, cursor, 3)).first()
    assert got.rows_loaded == 5
    assert got.new_cursor.replace(tzinfo=timezone.utc) == datetime(2024, 1, 10, 0, 0, 2, tzinfo=timezone.utc)


def test_split_from_text_and_null_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-01-02 23:59:59", 1), ("2024-01-03T00:00:00Z", 2), (None, 3)], "timestamp string, v int"
    )
    plan = L.split_plan(df).orderBy("v").collect()
    assert [r.file_name for r in plan] == ["20240102_OTA.parquet", "20240103_OTA.parquet"]


def test_split_rejects_unparsable_text(spark):
    import pytest

    df = spark.createDataFrame([("yesterday",)], "timestamp string")
    with pytest.raises(Exception):
        L.split_plan(df).collect()
    with pytest.raises(ValueError):
        L.split_plan(df.withColumnRenamed("timestamp", "ts"))


def test_serving_table_sql_text():
    from eventlake import schema as S

    ddl = SV.mysql_table_ddl("ota_events")
    assert "`request_id` VARCHAR(128) NOT NULL" in ddl and "`timestamp` DATETIME(6) NOT NULL" in ddl
    assert "`hotel_price` DECIMAL(18,6) NULL" in ddl and "`search_query` TEXT NULL" in ddl
    assert "PRIMARY KEY (`request_id`, `timestamp`)" in ddl and ddl.count("` ") >= 32
    merge = SV.mysql_merge_sql("ota_events", "ota_events_staging")
    assert merge.startswith("INSERT INTO `ota_events`") and "FROM `ota_events_staging`" in merge
    updated = merge.split("ON DUPLICATE KEY UPDATE", 1)[1]
    assert "`request_id` =" not in updated and "`timestamp` =" not in updated
    assert updated.count("= fresh.") == len(S.TYPED_COLUMNS) - 2
