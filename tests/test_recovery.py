"""Odd folders, interrupted writes, time zones, scripts."""

import os
import time
from datetime import date, datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.operators import dedupe as D
from eventlake.operators import serve as SV
from eventlake.operators import tables as TB
from eventlake.operators import typed as TY
from eventlake.plans import runs as RUNS
from eventlake.sources import fixture as X
from eventlake.sources import landing as L
from scales import SF_SMALL

UTC = timezone.utc


def day_file(path, n, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    rows = pd.DataFrame({c: ["1"] * n for c in S.RAW_COLUMNS} | columns)
    rows["request_id"] = [f"{path.stem}-{i}" for i in range(n)]
    rows["timestamp"] = pd.to_datetime(["2024-01-02 03:04:05.000001"] * n)
    rows.to_parquet(path)


def layout(folder):
    return RUNS.Layout(**{k: str(folder / k) for k in ("landing", "typed", "deduped", "serving", "cursor", "rejects")})


def test_entries_land_under_their_own_names(spark, folder):
    day_file(folder / "in/20240102_OTA.parquet", 3)
    day_file(folder / "in/20240102_HTL.parquet", 5)
    day_file(folder / "in/notes.parquet", 2)
    day_file(folder / "in/sub/20240102_OTA.parquet", 7)
    out = RUNS.land(spark, str(folder / "in"), str(folder / "out"), recursive=True)
    assert (out["uploaded"], out["skipped"]) == (3, 1)
    rows = spark.read.parquet(str(folder / "out")).groupBy(L.DAY_FILE).count().collect()
    assert {r[0]: r[1] for r in rows} == {"20240102_OTA.parquet": 3, "20240102_HTL.parquet": 5, "notes.parquet": 2}
    again = RUNS.land(spark, str(folder / "in"), str(folder / "out"))
    assert (again["uploaded"], again["skipped"]) == (0, 3)
    # landed again one after another: the last of a name stays, whatever its types
    day_file(folder / "in/zz/20240102_OTA.parquet", 4, user_id=[1, 2, 3, 4])
    RUNS.land(spark, str(folder / "in"), str(folder / "out"), skip_if_exists=False, recursive=True, suffix="OTA")
    assert spark.read.parquet(str(folder / "out/day_file=20240102_OTA.parquet")).count() == 4


def test_odd_names_and_types_in_the_landing_folder(spark, folder):
    lay = layout(folder)
    day_file(folder / "landing/20240102_OTA.parquet", 3)
    day_file(folder / "landing/20240103_OTA.parquet", 2, user_id=[7, 8], hotel_price=[12345678.0, 0.5])
    (folder / "landing/20261399_OTA.parquet").write_bytes(b"no parquet, no day")
    out = RUNS.recent(spark, lay, "2024-01-02", "2024-01-03")
    assert out["files"] == ["20240102_OTA.parquet", "20240103_OTA.parquet"] and out["typed"]["rows"] == 5
    got = {(r["user_id"], r["hotel_price"]) for r in TB.read_table(spark, lay.typed).collect()}
    assert {u for u, _ in got} == {1, 7, 8} and {float(p) for _, p in got} == {1.0, 12345678.0, 0.5}
    L.read_range(spark, lay.landing, "2024-01-02", "2024-01-02", view="ota_days")
    assert spark.table("ota_days").count() == 3
    plan = TB.read_table(spark, lay.deduped).where(SV.days_after(spark, RUNS.day_stats(lay), SV.cursor_start()))
    assert "PartitionFilters: [" in plan._jdf.queryExecution().toString() and "source_day" in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_drivers_zone(spark, folder, zone):
    before = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        noon = datetime(2024, 1, 7, 12, tzinfo=UTC)
        SV.write_cursor(spark, str(folder / "c"), noon)
        assert SV.read_cursor(spark, str(folder / "c")) == noon
        typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL)).limit(2)
        rows = typed.withColumn("request_id", F.monotonically_increasing_id().cast("string"))
        # either side of the hour that New York has twice
        stamps = F.when(F.col("request_id") == "0", F.expr("timestamp'2024-11-03 05:30:00Z'")).otherwise(F.expr("timestamp'2024-11-03 06:30:00Z'"))
        rows = rows.withColumn("timestamp", stamps).withColumn("source_day", F.lit(date(2024, 11, 3)))
        assert D.dedupe_keys(rows, "2024-11-03", "2024-11-03").count() == 2
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def test_an_interrupted_cursor_write_keeps_the_old_cursor(spark, folder):
    path = folder / "cursor"
    for hour in range(4):
        SV.write_cursor(spark, str(path), datetime(2024, 1, 7, hour, tzinfo=UTC))
    (path / "v000000000099").mkdir()  # begun, not complete
    assert SV.read_cursor(spark, str(path)) == datetime(2024, 1, 7, 3, tzinfo=UTC)
    SV.write_cursor(spark, str(path), datetime(2024, 1, 8, tzinfo=UTC))
    assert SV.read_cursor(spark, str(path)) == datetime(2024, 1, 8, tzinfo=UTC)


def test_keys_without_a_time_survive(spark, folder):
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, X.ALL_DELIVERIES))
    lay = layout(folder)
    TB.write_append(typed, lay.typed)
    table = TB.read_table(spark, lay.typed)
    TB.write_refresh(D.dedupe_full(table), lay.deduped)
    assert table.where("timestamp IS NULL").count() > 0
    want = sorted(map(str, D.dedupe_full(table).collect()))
    touched = D.touched_keys(table, "2024-01-01", "2024-01-31")
    assert touched.nulls
    TB.write_replace_keys(D.winners_of(table, touched), touched, lay.deduped)
    assert sorted(map(str, TB.read_table(spark, lay.deduped).collect())) == want


def test_interrupted_switches_are_finished(spark, folder):
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL))
    served = SV.serving_projection(D.dedupe_full(typed))
    path = str(folder / "serving")
    SV.write_upsert(served, path)
    want = sorted(map(str, spark.read.parquet(path).select(*S.TYPED_COLUMNS).collect()))
    # lost between removing old folders and putting the new ones in place
    TB.write_pending(spark.read.parquet(path), path)
    fs, gone = TB._fs(spark, f"{path}/event_date=2024-01-02")
    assert fs.delete(gone, True)
    SV.write_upsert(served.limit(0), path)
    assert sorted(map(str, spark.read.parquet(path).select(*S.TYPED_COLUMNS).collect())) == want
    table = str(folder / "deduped")
    TB.write_refresh(D.dedupe_full(typed), table)
    n = TB.read_table(spark, table).count()
    fs, here = TB._fs(spark, table)
    fs.rename(here, TB._fs(spark, f"{table}__old")[1])
    typed.limit(0).write.parquet(f"{table}__new")
    fs.delete(TB._fs(spark, f"{table}__new/_SUCCESS")[1], False)  # the new version was not complete
    fs.rename(TB._fs(spark, f"{table}__old")[1], here)
    assert TB.read_table(spark, table).count() == n


def test_a_rerun_without_rejects_clears_them(spark, folder):
    path = str(folder / "rejects")
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, X.ALL_DELIVERIES))
    assert SV.write_rejects(typed, path, "2024-01-01T00:00:00+00:00") > 0
    assert SV.write_rejects(typed.where("request_id IS NOT NULL AND timestamp IS NOT NULL AND length(currency) < 9 AND hotel_price < 1000"), path, "2024-01-01T00:00:00+00:00") == 0
    assert not [p for p in (folder / "rejects").iterdir() if p.name.startswith("load_from")]


def test_the_newest_copy_is_served_whichever_file_it_is_in(spark, folder):
    from eventlake.streaming import incremental as INC

    row = TY.fixture_typed(X.ota_raw(spark, SF_SMALL)).limit(1)
    for i, (loaded, page) in enumerate((("2024-05-02", "newer"), ("2024-05-01", "older"))):
        part = row.withColumn("ingested_at", F.lit(loaded).cast("timestamp")).withColumn("page_name", F.lit(page))
        TB.write_append(spark.createDataFrame(part.collect(), row.schema), str(folder / "deduped"))
        time.sleep(0.1)
    INC.load_available(spark, str(folder / "deduped"), str(folder / "serving"), str(folder / "ckpt"))
    assert [r["page_name"] for r in spark.read.parquet(str(folder / "serving")).collect()] == ["newer"]


SCRIPT = """
DECLARE lo DATE DEFAULT DATE'2024-01-02';
DECLARE n INT;
CREATE OR REPLACE TEMPORARY VIEW script_rows AS SELECT * FROM VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-02') AS v(id, d);
CREATE TABLE IF NOT EXISTS {name} (id INT, d DATE) USING parquet;
INSERT OVERWRITE {name} SELECT * FROM script_rows WHERE d >= lo;
INSERT INTO {name} SELECT id + 10, d FROM script_rows WHERE id <= :most;
SET n = (SELECT count(*) FROM {name});
SELECT id, n FROM {name};
"""


def test_scripts_of_several_statements(spark, folder):
    name = f"script_{os.getpid()}"
    (folder / "job.SQL").write_text(SCRIPT.replace("{name}", name))
    df, summary = TB.run_sql(spark, "job.SQL", args={"most": 1}, base_dir=str(folder))
    assert sorted(map(tuple, df.collect())) == [(2, 2), (11, 2)] and summary["rows"] == 2
    spark.sql(f"DROP TABLE {name}")


def test_a_chunk_is_lazy_and_ends_on_a_whole_moment(spark):
    ts = [datetime(2024, 1, 1, tzinfo=UTC) + timedelta(minutes=m // 3) for m in range(30)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(ts)], "timestamp timestamp, i int")
    for size, want in ((1, 3), (3, 3), (4, 6), (29, 30), (100, 30)):
        assert SV.first_chunk(df, SV.cursor_start(), size).count() == want


def test_the_callers_session_keeps_its_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        own = SESSION.scoped(spark)
        assert own.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
