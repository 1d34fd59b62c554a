"""Storage forms in a scratch folder: day files, range replace, refresh, upsert, runs."""

from datetime import date, datetime, timezone
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators import dedupe as D
from eventlake.operators import serve as SV
from eventlake.operators import tables as TB
from eventlake.operators import typed as TY
from eventlake.plans import runs as RUNS
from eventlake.sources import fixture as X
from eventlake.sources import landing as L
from scales import SF_SMALL

LOADED = datetime(2024, 3, 1, tzinfo=timezone.utc)


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((v is None, str(v)) for v in t))


def landed(spark, folder: Path) -> Path:
    """Bulk events split into day files under folder/landing."""
    bulk = folder / "bulk.parquet"
    X.bulk_raw(spark, SF_SMALL).coalesce(1).write.parquet(str(bulk))
    names = L.write_day_files(L.split_plan(L.read_bulk(spark, str(bulk))), str(folder / "landing"))
    assert names and all(n.endswith("_OTA.parquet") for n in names)
    return folder / "landing"


def test_split_writes_one_entry_per_day_and_keeps_other_days(spark, folder):
    landing = landed(spark, folder)
    names = [r.name for r in L.list_entries(spark, str(landing)).collect()]
    assert names[0] == "20240101_OTA.parquet" and len(names) == 30
    assert (landing / "day_file=20240101_OTA.parquet").is_dir()
    # re-split one day with other content: that day is replaced, the rest stays
    one = L.read_range(spark, str(landing), "2024-01-05", "2024-01-05").drop("source_file").limit(3)
    L.write_day_files(L.split_plan(one), str(landing))
    assert L.read_range(spark, str(landing), "2024-01-05", "2024-01-05").count() == 3
    assert L.read_range(spark, str(landing), "2024-01-06", "2024-01-06").count() > 3
    assert L.list_entries(spark, str(landing)).count() == 30


def test_range_read_opens_only_range_files(spark, folder):
    landing = landed(spark, folder)
    # a corrupt file in a day outside the range must never be opened
    (landing / "day_file=20240120_OTA.parquet" / "part-corrupt.parquet").write_bytes(b"not parquet")
    n = L.read_range(spark, str(landing), "2024-01-10", "2024-01-12").count()
    assert n == X.ota_raw(spark, SF_SMALL, (X.DELIVERY_A,)).where(
        F.col("source_file").rlike("2024011[012]_OTA")).count()
    with pytest.raises(Exception):
        L.read_day_files(spark, str(landing)).count()


def test_layout_fixture(spark, folder):
    """Odd names: no date, nine digits, other suffix, nanosecond timestamps."""
    landing = folder / "landing"
    landing.mkdir()
    base = pd.DataFrame({c: ["1"] for c in S.RAW_COLUMNS})
    base["timestamp"] = pd.to_datetime(["2024-01-02 03:04:05.123456789"])  # TIMESTAMP(NANOS)
    for name in ["20240102_OTA.parquet", "foo_OTA.parquet", "120240103_OTA.parquet", "20240102_XYZ.parquet"]:
        base.to_parquet(landing / name)
    raw = L.read_day_files(spark, str(landing))
    assert raw.schema["timestamp"].dataType.simpleString() == "bigint"  # nanos read as long
    typed = TY.typed_events(raw, ingested_at=LOADED)
    got = {Path(r.source_file).name: (r.source_day, r.timestamp) for r in typed.collect()}
    assert set(got) == {"20240102_OTA.parquet", "foo_OTA.parquet", "120240103_OTA.parquet"}
    assert got["foo_OTA.parquet"][0] is None
    assert got["120240103_OTA.parquet"][0] == date(2024, 1, 3)
    assert got["20240102_OTA.parquet"][1].microsecond == 123456  # sub-microsecond digits dropped
    listing = L.list_entries(spark, str(landing))
    assert L.select_by_filters(listing, suffix="XYZ").count() == 1
    assert L.select_by_filters(listing, date_start="20240102", suffix="OTA").count() == 1  # 9 digits: no match


def test_selection_errors(spark, folder):
    landing = landed(spark, folder)
    listing = L.list_entries(spark, str(landing))
    with pytest.raises(FileNotFoundError, match="20990101_OTA"):
        L.pick_files(listing, names=["20240101_OTA.parquet", "20990101_OTA.parquet"])
    with pytest.raises(ValueError):
        L.pick_files(listing, date_start="2024-01-01")
    with pytest.raises(FileNotFoundError):
        L.pick_files(listing, date_start="20990101")
    assert L.pick_files(listing, names=["20240101_OTA.parquet"], date_start="20990101").count() == 1
    assert L.pick_files(listing).count() == 30
    with pytest.raises(FileNotFoundError):
        L.list_entries(spark, str(folder / "missing"))


def test_land_skips_existing(spark, folder):
    landing = landed(spark, folder)
    target = folder / "target"
    first = RUNS.land(spark, str(landing), str(target), date_end="20240110")
    assert (first["uploaded"], first["skipped"]) == (10, 0)
    second = RUNS.land(spark, str(landing), str(target))
    assert (second["uploaded"], second["skipped"]) == (20, 10)
    assert L.read_day_files(spark, str(target)).count() == L.read_day_files(spark, str(landing)).count()


def typed_table(spark, folder, deliveries=X.DELIVERIES):
    path = str(folder / "typed")
    TB.write_append(TY.fixture_typed(X.ota_raw(spark, SF_SMALL, deliveries)), path)
    return path


def test_replace_range_on_storage_matches_pure_form(spark, folder):
    path = typed_table(spark, folder, (X.DELIVERY_A,))
    target = TB.read_table(spark, path)
    before = rows_of(target)
    batch = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_B, X.DELIVERY_D)))
    want = rows_of(TB.replace_range(spark.createDataFrame(target.collect(), target.schema), batch,
                                    X.RANGE_START, X.RANGE_END))
    TB.write_replace_range(batch, path, X.RANGE_START, X.RANGE_END)
    assert rows_of(TB.read_table(spark, path)) == want != before
    # twice = once
    TB.write_replace_range(batch, path, X.RANGE_START, X.RANGE_END)
    assert rows_of(TB.read_table(spark, path)) == want


def test_replace_range_empties_days_without_rows_and_keeps_null_days(spark, folder):
    path = typed_table(spark, folder, (X.DELIVERY_A,))
    nulls = TB.read_table(spark, path).limit(5).withColumn("source_day", F.lit(None).cast("date"))
    TB.write_append(nulls, path)
    only_day_one = TB.read_table(spark, path).where(F.col("source_day") == F.lit("2024-01-10").cast("date"))
    only_day_one = spark.createDataFrame(only_day_one.collect(), only_day_one.schema)
    report = TB.write_replace_range(only_day_one, path, "2024-01-10", "2024-01-12")
    assert report["days_emptied"] == [date(2024, 1, 11), date(2024, 1, 12)]
    after = TB.read_table(spark, path)
    days = {r[0] for r in after.select("source_day").distinct().collect()}
    assert date(2024, 1, 10) in days and date(2024, 1, 11) not in days and None in days
    assert after.where(F.col("source_day").isNull()).count() == 5


def test_refresh_replaces_everything(spark, folder):
    typed = typed_table(spark, folder)
    deduped = str(folder / "deduped")
    TB.write_append(TB.read_table(spark, typed), deduped)  # stale content with all days
    TB.write_refresh(D.dedupe_full(TB.read_table(spark, typed)), deduped)
    assert TB.read_table(spark, deduped).count() == 1020
    # refresh from itself is staged first, so it can overwrite what it reads
    TB.write_refresh(TB.read_table(spark, deduped).where(F.col("source_day") < F.lit("2024-01-05").cast("date")),
                     deduped)
    assert TB.read_table(spark, deduped).where(F.col("source_day") >= F.lit("2024-01-05").cast("date")).count() == 0


def test_upsert_storage_twice_is_once(spark, folder):
    serving = str(folder / "serving")
    first = SV.serving_projection(D.dedupe_full(TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_A,)))))
    whole = SV.serving_projection(D.dedupe_full(TY.fixture_typed(X.ota_raw(spark, SF_SMALL))))
    SV.write_upsert(first, serving)
    SV.write_upsert(whole, serving)
    once = rows_of(spark.read.parquet(serving))
    SV.write_upsert(whole, serving)
    assert rows_of(spark.read.parquet(serving)) == once
    assert len(once) == 1000
    assert once == rows_of(SV.upsert(first, whole).select(*spark.read.parquet(serving).columns))


def test_cursor_rules(spark, folder):
    assert SV.cursor_start().source == "epoch"
    assert SV.cursor_start(stored="2024-01-05T00:00:00+00:00").source == "state"
    c = SV.cursor_start(param="2024-01-20T06:30:00+02:00", override="2024-01-01")
    assert c.source == "param" and c.ts.hour == 4 and not c.inclusive
    c = SV.cursor_start(override="2024-01-10")
    assert c.inclusive and c.ts == datetime(2024, 1, 10, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        SV.cursor_start(param="yesterday")
    path = str(folder / "cursor")
    assert SV.read_cursor(spark, path) is None
    SV.write_cursor(spark, path, datetime(2024, 1, 7, tzinfo=timezone.utc))
    assert SV.read_cursor(spark, path) == datetime(2024, 1, 7, tzinfo=timezone.utc)


def layout(folder: Path) -> RUNS.Layout:
    return RUNS.Layout(
        landing=str(folder / "landing"), typed=str(folder / "typed"), deduped=str(folder / "deduped"),
        serving=str(folder / "serving"), cursor=str(folder / "cursor"), rejects=str(folder / "rejects"),
    )


def test_recent_without_files_exits_cleanly(spark, folder):
    out = RUNS.recent(spark, layout(folder), "2030-01-01", "2030-01-03")
    assert out["status"] == "no_data"
    assert not (folder / "typed").exists()


def test_historic_then_recent(spark, folder):
    lay = layout(folder)
    bulk = folder / "bulk.parquet"
    X.bulk_raw(spark, SF_SMALL).coalesce(1).write.parquet(str(bulk))
    hist = RUNS.historic(spark, lay, str(bulk), loaded_at=LOADED)
    assert hist["status"] == "done" and hist["split"]["num_files"] == 30
    served = spark.read.parquet(lay.serving)
    assert served.count() == 1000
    cursor = SV.read_cursor(spark, lay.cursor)
    assert cursor is not None
    # recent run over three days, backfilling from the start date
    out = RUNS.recent(spark, lay, "2024-01-10", "2024-01-12", loaded_at=datetime(2024, 3, 2, tzinfo=timezone.utc))
    assert out["status"] == "done" and len(out["files"]) == 3
    deduped = TB.read_table(spark, lay.deduped)
    assert deduped.count() == 1000
    keys = rows_of(deduped, S.DEDUPE_KEY)
    # re-running the same recent run changes nothing but load times
    RUNS.recent(spark, lay, "2024-01-10", "2024-01-12", loaded_at=datetime(2024, 3, 2, tzinfo=timezone.utc))
    assert rows_of(TB.read_table(spark, lay.deduped), S.DEDUPE_KEY) == keys
    assert spark.read.parquet(lay.serving).count() == 1000


def test_streaming_load_equals_batch_load(spark, folder):
    from eventlake.streaming import incremental as INC

    deduped = str(folder / "deduped")
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL))
    TB.write_replace_range(D.dedupe_range(typed, "2024-01-01", "2024-01-15"), deduped, "2024-01-01", "2024-01-15")
    serving, ckpt = str(folder / "serving"), str(folder / "ckpt")
    first = INC.load_available(spark, deduped, serving, ckpt, rejects_path=str(folder / "rejects"))
    assert first["rows"] > 0
    again = INC.load_available(spark, deduped, serving, ckpt)
    assert again["rows"] == 0  # nothing new
    TB.write_replace_range(D.dedupe_range(typed, "2024-01-16", "2024-01-31"), deduped, "2024-01-16", "2024-01-31")
    later = INC.load_available(spark, deduped, serving, ckpt)
    assert 0 < later["rows"] < first["rows"] + later["rows"]
    batch = SV.upsert(spark.createDataFrame([], S.SERVING_SCHEMA),
                      SV.serving_projection(TB.read_table(spark, deduped)))
    assert rows_of(spark.read.parquet(serving)) == rows_of(batch.select(*spark.read.parquet(serving).columns))


def test_recent_keys_scope_equals_full_rebuild(spark, folder):
    lay = layout(folder)
    raw = X.ota_raw(spark, SF_SMALL)
    # landing holds every delivery's day files (redrop lane included)
    lanes = raw.withColumn("lane", F.regexp_extract("source_file", r"landing/([a-z]+)/", 1))
    for lane in ["daily", "redrop"]:
        part = lanes.where(F.col("lane") == lane).drop("lane", "ingested_at")
        plan = part.withColumn("day_key", F.regexp_extract("source_file", r"(\d{8})_OTA", 1)).drop("source_file")
        L.write_day_files(plan, str(folder / lane))
    # typed table and deduplicated table as the first load left them (daily lane only)
    first = TY.typed_events(L.read_day_files(spark, str(folder / "daily")), ingested_at=LOADED)
    TB.write_append(first, lay.typed)
    TB.write_refresh(D.dedupe_full(TB.read_table(spark, lay.typed)), lay.deduped)
    # the redrop lane arrives; a keys-scope recent run over three days
    lay2 = RUNS.Layout(landing=str(folder / "redrop"), typed=lay.typed, deduped=lay.deduped,
                       serving=lay.serving, cursor=lay.cursor)
    out = RUNS.recent(spark, lay2, "2024-01-10", "2024-01-12", loaded_at=datetime(2024, 3, 2, tzinfo=timezone.utc),
                      scope="keys")
    assert out["status"] == "done"
    want = rows_of(D.dedupe_full(TB.read_table(spark, lay.typed)))
    assert rows_of(TB.read_table(spark, lay.deduped)) == want


def test_bulk_read_errors(spark, folder):
    with pytest.raises(FileNotFoundError):
        L.read_bulk(spark, str(folder / "missing.parquet"))
    path = folder / "no_ts.parquet"
    spark.range(3).write.parquet(str(path))
    with pytest.raises(ValueError, match="timestamp"):
        L.read_bulk(spark, str(path))


def test_load_time_is_one_value_per_statement(spark, folder):
    landing = landed(spark, folder)
    typed = TY.typed_events(L.read_day_files(spark, str(landing)))  # ingested_at = current_timestamp()
    assert typed.select("ingested_at").distinct().count() == 1
    with pytest.raises(ValueError, match="lacks columns"):
        TY.typed_events(L.read_day_files(spark, str(landing)).drop("nights"))


def test_listing_an_empty_folder_is_an_error(spark, folder):
    (folder / "empty").mkdir()
    (folder / "empty" / "notes.txt").write_text("not parquet")
    with pytest.raises(FileNotFoundError, match="no .parquet"):
        L.list_entries(spark, str(folder / "empty"))
    (folder / "empty" / "sub").mkdir()
    spark.range(2).write.parquet(str(folder / "empty" / "sub" / "20240101_OTA.parquet"))
    with pytest.raises(FileNotFoundError):
        L.list_entries(spark, str(folder / "empty"))
    assert [r.name for r in L.list_entries(spark, str(folder / "empty"), recursive=True).collect()] == [
        "20240101_OTA.parquet"]


def test_historic_with_export_lands_only_new_days(spark, folder):
    lay = layout(folder)
    bulk = folder / "bulk.parquet"
    X.bulk_raw(spark, SF_SMALL).coalesce(1).write.parquet(str(bulk))
    first = RUNS.historic(spark, lay, str(bulk), loaded_at=LOADED, export=str(folder / "export"))
    assert first["land"]["uploaded"] == 30 and first["land"]["skipped"] == 0
    second = RUNS.historic(spark, lay, str(bulk), loaded_at=LOADED, export=str(folder / "export"))
    assert second["land"]["uploaded"] == 0 and second["land"]["skipped"] == 30
    assert TB.read_table(spark, lay.deduped).count() == 1000  # the re-run's duplicate raw rows deduplicate away
    assert TB.read_table(spark, lay.typed).count() == 2000  # a historic re-run appends again


def test_name_pattern_forms(spark):
    listing = spark.createDataFrame(
        [("x/20240101_OTA.parquet", "20240101_OTA.parquet"), ("x/OTA-20240102.parquet", "OTA-20240102.parquet"),
         ("x/a20240103_OTA.parquet", "a20240103_OTA.parquet")], "path string, name string")
    py = r"^(?P<date>\d{8})_(?P<suffix>[A-Za-z0-9]+)\.parquet$"
    assert [r.name for r in L.select_by_filters(listing, suffix="OTA", pattern=py).collect()] == ["20240101_OTA.parquet"]
    swapped = r"(?<suffix>[A-Z]+)-(?<date>\d{8})\.parquet"
    got = L.select_by_filters(listing, date_start="20240102", pattern=swapped).collect()
    assert [(r.file_date, r.file_suffix) for r in got] == [("20240102", "OTA")]
    # matched from the start, as re.match does: "a2024..." does not match an unanchored day pattern
    assert L.select_by_filters(listing, suffix="OTA", pattern=r"(\d{8})_([A-Z]+)\.parquet").count() == 1


def test_hot_day_is_written_by_several_tasks(spark, folder):
    bulk = X.bulk_raw(spark, SF_SMALL)
    hot = bulk.where(F.col("timestamp") < F.lit(1_704_153_600_000_000_000))  # the first day
    n = bulk.count()
    copies = max(1, (n // 2) // max(hot.count(), 1))
    skewed = bulk.unionByName(hot.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_c"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        L.write_day_files(L.split_plan(skewed), str(folder / "landing"))
    finally:
        spark.conf.set(key, before)
    parts = [p for p in (folder / "landing" / "day_file=20240101_OTA.parquet").iterdir() if p.suffix == ".parquet"]
    assert len(parts) > 1
    assert L.read_range(spark, str(folder / "landing"), "2024-01-01", "2024-01-01").count() == hot.count() * (1 + copies)


def test_rejects_are_replaced_when_a_load_reruns(spark, folder):
    lay = layout(folder)
    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL))
    bad = (typed.limit(7).withColumn("currency", F.lit("X" * 20))
           .withColumn("request_id", F.concat(F.lit("bad-"), F.monotonically_increasing_id().cast("string"))))
    rows = spark.createDataFrame(typed.unionByName(bad).collect(), typed.schema)
    TB.write_refresh(D.dedupe_full(rows), lay.deduped)
    cursor = SV.cursor_start(param="2024-01-01T00:00:00Z")
    first = RUNS.load(spark, lay, cursor)
    RUNS.load(spark, lay, cursor)
    rejects = spark.read.parquet(lay.rejects)
    assert rejects.count() == 7 and rejects.select("load_from").distinct().count() == 1
    assert first["rows"] == 1020  # deduplicated rows loaded ...
    assert spark.read.parquet(lay.serving).count() == 1000  # ... one per serving key
