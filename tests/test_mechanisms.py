"""Order along a curve, visible versions, filters by day, changes, chunks."""

import itertools
import random
import re
from datetime import date, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators import dedupe as D
from eventlake.operators import ordering as OR
from eventlake.operators import tables as TB
from eventlake.operators import typed as TY
from eventlake.operators import versions as VS
from eventlake.sources import fixture as X
from scales import SF_LARGE, SF_SMALL


def rows_of(df, cols=None):
    return sorted(map(str, df.select(*(cols or S.TYPED_COLUMNS)).collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- order ----------------------------------------------------------------------


def test_running_counts_number_rows_in_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), (F.col("id") % 4 + 1).alias("n"))
    out = OR.running_counts(rows, ["v"], "n").orderBy("v").collect()
    at = 0
    for r in out:
        assert (r["before"], r["upto"]) == (at, at + r["n"])
        at += r["n"]
    assert len(out) == 5000
    assert OR.running_counts(rows.limit(0), ["v"], "n").count() == 0


def groups_read(folder, column, value):
    """(row groups whose statistics admit the value, row groups)."""
    hit = every = 0
    for file in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column)
            every += 1
            hit += bool(stats.has_min_max and stats.min <= value <= stats.max)
    return hit, every


def test_a_filter_on_any_clustering_column_skips_row_groups(spark, folder):
    typed = TY.fixture_typed(X.ota_raw(spark, SF_LARGE)).withColumn("source_day", F.lit("2024-01-02").cast("date"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    small = {"parquet.block.size": 64 << 10, "parquet.block.size.row.check.min": 100, "parquet.page.size.row.check.min": 100}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before, kept = spark.conf.get(key), {k: conf.get(k) for k in small}
    spark.conf.set(key, "64m")
    for k, v in small.items():
        conf.set(k, str(v))
    try:
        OR.write_along(typed, str(folder / "curve"))
        # the plain order: by the columns from the first to the last
        typed.sortWithinPartitions(*OR.CURVE_COLUMNS).write.partitionBy("source_day").parquet(str(folder / "plain"))
    finally:
        spark.conf.set(key, before)
        for k, v in kept.items():
            conf.unset(k) if v is None else conf.set(k, v)
    assert TB.read_table(spark, str(folder / "curve")).exceptAll(typed).isEmpty()
    share = {}
    for name in ("curve", "plain"):
        for column, value in (("hotel_id", 64), ("funnel_id", "f20"), ("page_name", "purchase"), ("country", "TR")):
            hit, every = groups_read(folder / name, column, value)
            share[name, column] = hit / every
    assert every >= 300
    # the plain order is best on its first columns and opens nearly all for the last
    assert share["plain", "funnel_id"] >= 0.8, share
    assert all(share["curve", c] <= 0.35 for c in OR.CURVE_COLUMNS), share


def test_limits_of_nulls_and_few_values(spark):
    df = spark.createDataFrame([(None, "a", 1, None)] * 3 + [("x", "a", None, "f")], "country string, page_name string, hotel_id bigint, funnel_id string")
    on = OR.curve(df)
    assert [len(on.limits[c]) for c in OR.CURVE_COLUMNS] == [1, 1, 1, 1]
    assert {r[0] for r in df.select(on.place()).collect()} == {0}
    empty = OR.curve(df.limit(0))
    assert {r[0] for r in df.select(empty.place()).collect()} == {0}


# --- versions -------------------------------------------------------------------


class Lost(Exception):
    pass


def stop_at(name):
    def step(at):
        if at == name:
            raise Lost(at)

    return step


def test_spans_after_replacements():
    d = lambda n: date(2024, 1, n)
    spans = [(d(1), d(31), 0)]
    spans = VS.over(spans, d(10), d(12), 1)
    assert spans == [(d(1), d(9), 0), (d(10), d(12), 1), (d(13), d(31), 0)]
    assert VS.over(spans, d(5), d(11), 2) == [(d(1), d(4), 0), (d(5), d(11), 2), (d(12), d(12), 1), (d(13), d(31), 0)]
    assert VS.over(spans, d(1), d(31), 3) == [(d(1), d(31), 3)]
    assert VS.over([], d(1), d(2), 0) == [(d(1), d(2), 0)]


def test_a_reader_sees_the_old_or_the_new_range(spark, folder):
    first = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_A, X.DELIVERY_E)))
    # the last day of the range has no incoming rows: it is emptied in the same step
    batch = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_B, X.DELIVERY_D))).where("source_day <> DATE'2024-01-12'")
    VS.create(spark, "seen.days", str(folder / "days"))
    VS.refresh(first, "seen.days")
    old = rows_of(spark.table("seen.days"))
    assert old == rows_of(first) and spark.table("seen.days").where("source_day IS NULL").count() > 0
    new = rows_of(TB.replace_range(first, batch, X.RANGE_START, X.RANGE_END))
    reader = spark.table("seen.days")  # planned before the replacement
    for at in ("files", "partitions"):
        with pytest.raises(Lost):
            VS.replace_days(batch, "seen.days", X.RANGE_START, X.RANGE_END, step=stop_at(at))
        assert rows_of(spark.table("seen.days")) == old
    with pytest.raises(Lost):
        VS.replace_days(batch, "seen.days", X.RANGE_START, X.RANGE_END, step=stop_at("view"))
    assert rows_of(spark.table("seen.days")) == new
    assert rows_of(reader) == old
    assert VS.vacuum(spark, "seen.days") == [1, 2]
    assert rows_of(spark.table("seen.days")) == new
    # again, from the view itself
    VS.replace_days(spark.table("seen.days"), "seen.days", X.RANGE_START, X.RANGE_END)
    assert rows_of(spark.table("seen.days")) == new
    plan = plan_of(spark.table("seen.days").where("source_day = DATE'2024-01-11'"))
    assert "PartitionFilters: [" in plan and "version" in plan
    scan = spark.table("seen.days").where("source_day = DATE'2024-01-11'")
    assert {p.split("version=")[1].split("/")[0] for p in scan.inputFiles()} == {"4"}


# --- chunks ---------------------------------------------------------------------


@pytest.mark.parametrize("size,blocks,together,top", [(7, 256, 64, 100_000), (7, 2, 2, 3), (1, 3, 2, 1), (40, 1, 3, 5), (1000, 1, 2, 1)])
def test_chunks_equal_the_loop(spark, monkeypatch, size, blocks, together, top):
    from eventlake.operators import chunks as CH
    from eventlake.operators import serve as SV

    monkeypatch.setattr(CH, "BLOCK_CHUNKS", blocks)
    monkeypatch.setattr(CH, "TOGETHER", together)
    monkeypatch.setattr(CH, "TOP_ROWS", top)
    rng = random.Random(size)
    seconds = [rng.choice([rng.randrange(200), 50, 51]) for _ in range(400)] + [77] * 60
    df = spark.createDataFrame([(s, i) for i, s in enumerate(seconds)], "s int, i int").selectExpr("CASE WHEN i = 3 THEN NULL ELSE timestamp_seconds(1700000000 + s) END AS timestamp", "i")
    cursor = SV.cursor_start(param="2023-11-14T22:13:25Z")
    rows, ends = CH.in_chunks(df, cursor, size)
    got = {r["i"]: r["chunk"] for r in rows.collect()}
    told = {r["chunk"]: (r["rows"], r["new_cursor"]) for r in ends.collect()}
    after = sorted((1700000000 + s, i) for i, s in enumerate(seconds) if i != 3 and 1700000000 + s > cursor.ts.timestamp())
    chunk, at = 0, 0
    while at < len(after):  # the loop: a chunk after another
        end = min(at + size, len(after))
        while end < len(after) and after[end][0] == after[end - 1][0]:
            end += 1
        assert {got[i] for _, i in after[at:end]} == {chunk}
        assert told[chunk][0] == end - at and told[chunk][1].replace(tzinfo=timezone.utc).timestamp() == after[end - 1][0]
        at, chunk = end, chunk + 1
    assert len(got) == len(after) and len(told) == chunk
    none, no_ends = CH.in_chunks(df, SV.cursor_start(param="2099-01-01T00:00:00Z"), size)
    assert none.count() == no_ends.count() == 0


# --- day statistics ---------------------------------------------------------------


@pytest.mark.parametrize("lost_at", ["forget_days", "write_replace_range", "write_day_stats", "load", None])
def test_no_row_is_lost_with_a_run(spark, folder, monkeypatch, lost_at):
    """A recent run is lost at each of its steps, and the next covers other days."""
    from eventlake.operators import serve as SV
    from eventlake.plans import runs as RUNS
    from eventlake.sources import landing as L

    lay = RUNS.Layout(**{k: str(folder / k) for k in ("landing", "typed", "deduped", "serving", "cursor")})
    bulk = X.bulk_raw(spark, SF_SMALL)
    early = bulk.where(F.expr("timestamp < unix_micros(timestamp'2024-01-03') * 1000"))
    L.write_day_files(L.split_plan(early), lay.landing)
    RUNS.recent(spark, lay, "2024-01-01", "2024-01-02")
    whole = bulk.where(F.expr("timestamp < unix_micros(timestamp'2024-01-05') * 1000"))
    # the second day comes again, with its rows moved to the end of that day; then two new days
    late = whole.withColumn("timestamp", F.expr("CASE WHEN timestamp < unix_micros(timestamp'2024-01-02') * 1000 THEN timestamp ELSE timestamp END"))
    L.write_day_files(L.split_plan(late.where(F.expr("timestamp >= unix_micros(timestamp'2024-01-03') * 1000"))), lay.landing)
    SV.write_day_stats(spark, TB.read_table(spark, lay.deduped), RUNS.day_stats(lay))
    # the statistics name the third day with an old time, as after an earlier delivery of it
    stats = SV.read_state(spark, RUNS.day_stats(lay), SV.DAYS_SCHEMA)
    SV.write_state(stats.unionByName(spark.createDataFrame([(date(2024, 1, 3), 1)], SV.DAYS_SCHEMA)), RUNS.day_stats(lay))
    if lost_at:
        holder = {"forget_days": SV, "write_replace_range": TB, "write_day_stats": SV, "load": RUNS}[lost_at]
        real, calls = getattr(holder, lost_at), []

        def dies(*a, **k):
            calls.append(1)
            if lost_at == "write_replace_range":
                real(*a, **k)
                if len(calls) < 2:
                    return {}
            raise Lost(lost_at)

        with monkeypatch.context() as m:
            m.setattr(holder, lost_at, dies)
            with pytest.raises(Lost):
                RUNS.recent(spark, lay, "2024-01-03", "2024-01-03")
    else:
        RUNS.recent(spark, lay, "2024-01-03", "2024-01-03")
    if lost_at == "forget_days":  # nothing was replaced yet: the day is as missing as before the run
        RUNS.recent(spark, lay, "2024-01-03", "2024-01-03")
    RUNS.recent(spark, lay, "2024-01-04", "2024-01-04")  # without its start as cursor it would be a backfill
    cursor = SV.read_cursor(spark, lay.cursor)
    assert cursor is not None
    served = {(r[0], r[1]) for r in spark.read.parquet(lay.serving).select("request_id", "timestamp").collect()}
    missing = TB.read_table(spark, lay.deduped).where("source_day <> DATE'2024-01-03'").count()
    assert missing <= len(served)
    RUNS.load(spark, lay, SV.cursor_start(override="2024-01-01"))
    everything = spark.read.parquet(lay.serving).count()
    assert everything == TB.read_table(spark, lay.deduped).count()


def test_a_lost_run_leaves_its_days_to_be_read(spark, folder):
    from eventlake.operators import serve as SV

    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_A,)))
    table, stats = str(folder / "deduped"), str(folder / "stats")
    TB.write_refresh(D.dedupe_full(typed), table)
    SV.write_day_stats(spark, TB.read_table(spark, table), stats)
    cursor = SV.cursor_start(param="2024-01-20T00:00:00Z")
    read = lambda: {r[0] for r in TB.read_table(spark, table).where(SV.days_after(spark, stats, cursor)).select("source_day").distinct().collect()}
    after = {date(2024, 1, d) for d in range(20, 31)}
    assert read() == after
    SV.forget_days(spark, stats, [date(2024, 1, 5)])
    assert read() == after | {date(2024, 1, 5)}
    # a day that the statistics have never heard of
    TB.write_append(typed.limit(3).withColumn("source_day", F.lit("2023-12-01").cast("date")), table)
    assert read() == after | {date(2024, 1, 5), date(2023, 12, 1)}
    SV.write_day_stats(spark, TB.read_table(spark, table), stats, [date(2023, 12, 1)])  # and the unknown one with it
    assert read() == after
    SV.forget_days(spark, stats)
    assert len(read()) == 31
    SV.write_day_stats(spark, TB.read_table(spark, table), stats, [date(2024, 1, 5)])
    assert read() == after


# --- changes ----------------------------------------------------------------------


def test_only_dates_with_changes_are_written(spark, folder):
    from eventlake.operators import serve as SV

    served = str(folder / "serving")
    first = SV.serving_projection(D.dedupe_full(TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_A,)))))
    one = SV.write_upsert(first, served)
    assert (one["inserted"], one["changed"], one["unchanged"]) == (1000, 0, 0)
    files = lambda: {p: p.stat().st_mtime_ns for p in (folder / "serving").rglob("*.parquet")}
    before = files()
    again = SV.write_upsert(first, served)
    assert (again["inserted"], again["changed"], again["unchanged"], again["dates"]) == (0, 0, 1000, [])
    assert files() == before  # nothing was written
    rows = first.where("event_date IN (DATE'2024-01-03', DATE'2024-01-04')")
    other = rows.withColumn("page_name", F.expr("CASE WHEN event_date = DATE'2024-01-03' THEN NULL ELSE page_name END"))
    new = rows.limit(1).withColumn("request_id", F.lit("new")).withColumn("event_date", F.lit(date(2025, 1, 1)))
    third = SV.write_upsert(spark.createDataFrame(other.unionByName(new).collect(), first.schema), served)
    n = rows.where("event_date = DATE'2024-01-03'").count()
    assert (third["inserted"], third["changed"]) == (1, n) and third["unchanged"] == rows.count() - n
    assert third["dates"] == [date(2024, 1, 3), date(2025, 1, 1)]
    after = files()
    kept = [p for p in before if "event_date=2024-01-03" not in str(p)]
    assert all(after[p] == before[p] for p in kept)
    back = spark.read.parquet(served)
    assert back.count() == 1001 and back.where("page_name IS NULL").count() == n


# --- filters by day ----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_a_filter_never_hides_a_day(spark, folder, seed):
    from eventlake.operators import day_filters as DF

    rng = random.Random(seed)
    days = [None] + [date(2024, 3, d) for d in range(1, 9)]
    rows = [(rng.choice([None, f"r{rng.randrange(300)}", "é" * rng.randrange(4)]), rng.choice(days)) for _ in range(900)]
    cols = [F.col("request_id"), F.col("source_day")] + [F.lit(None).cast(f.dataType).alias(f.name) for f in S.TYPED_SCHEMA.fields if f.name not in ("request_id", "source_day")]
    df = spark.createDataFrame(rows, "request_id string, source_day date").select(*cols)
    path = str(folder / "typed")
    TB.write_append(df, path)
    DF.build(spark, path)
    wanted = [None, ""] + [f"r{rng.randrange(600)}" for _ in range(5)]
    for some in (wanted, wanted[:1], wanted[-2:], []):
        keys = spark.createDataFrame([(k,) for k in some], "request_id string")
        hold = {d for k, d in rows if k in some and d is not None}
        table = TB.read_table(spark, path)
        seen = {r[0] for r in table.where(DF.may_hold(spark, path, keys)).select("source_day").distinct().collect()} - {None}
        assert hold <= seen and len(seen) <= len(hold) + 1  # a false yes is rare
    DF.forget(spark, path, [date(2024, 3, 4)])
    none = spark.createDataFrame([], "request_id string")
    read = lambda: {r[0] for r in TB.read_table(spark, path).where(DF.may_hold(spark, path, none)).select("source_day").distinct().collect()}
    assert read() == {None, date(2024, 3, 4)}
    DF.build(spark, path, [])  # builds what has none
    assert read() == {None}
    DF.forget(spark, path)
    assert len(read()) == 9


def test_keys_scope_opens_only_days_that_may_hold_a_key(spark, folder):
    from eventlake.operators import day_filters as DF

    path = str(folder / "typed")
    TB.write_append(TY.fixture_typed(X.ota_raw(spark, SF_SMALL)), path)
    DF.build(spark, path)
    table = TB.read_table(spark, path)
    some = table.where("source_day = DATE'2024-01-10'").limit(3)
    narrowed = table.where(DF.may_hold(spark, path, some.select("request_id")))
    filters = re.search(r"PartitionFilters: \[[^\]]*", plan_of(narrowed)).group()
    assert "source_day" in filters
    opened = {r[0] for r in narrowed.select("source_day").distinct().collect()}
    holds = {r[0] for r in table.join(some.select("request_id").distinct(), "request_id").select("source_day").distinct().collect()}
    assert holds <= opened and len(opened) < 8


# --- the newest copy as a stream ----------------------------------------------------


def test_state_equals_the_full_rebuild_after_any_deliveries(spark, folder):
    from eventlake.streaming import latest as LT

    order = list(X.ALL_DELIVERIES)
    random.Random(7).shuffle(order)
    typed, live, state = (str(folder / n) for n in ("typed", "live", "state"))
    for i, some in enumerate([order[:1], order[1:3], order[3:]]):
        rows = TY.fixture_typed(X.ota_raw(spark, SF_SMALL, tuple(some)))
        TB.write_append(rows, typed)
        assert LT.keep_latest(spark, typed, live, state) == rows.count()
        assert rows_of(LT.read_live(spark, live)) == rows_of(D.dedupe_full(TB.read_table(spark, typed)))
    assert LT.keep_latest(spark, typed, live, state) == 0
    # an older copy that comes late changes nothing
    before = rows_of(LT.read_live(spark, live))
    old = TB.read_table(spark, typed).limit(20).withColumn("ingested_at", F.lit("2001-01-01").cast("timestamp"))
    TB.write_append(spark.createDataFrame(old.collect(), old.schema), typed)
    assert LT.keep_latest(spark, typed, live, state) == 20
    assert rows_of(LT.read_live(spark, live)) == before
    # a replacement lost between its two steps is finished by the next
    TB.write_pending(LT.read_live(spark, live), live)
    fs, gone = TB._fs(spark, f"{live}/event_date=2024-01-02")
    assert fs.delete(gone, True)
    LT.put_winners(LT.read_live(spark, live).limit(0), live)
    assert rows_of(LT.read_live(spark, live)) == before


# --- buckets -------------------------------------------------------------------------


def test_bucketed_plans_have_no_exchange(spark, folder):
    from eventlake.operators import bucketed as B
    from eventlake.operators import serve as SV

    typed = TY.fixture_typed(X.ota_raw(spark, SF_SMALL))
    B.write_bucketed(typed, "b_typed", str(folder / "typed"), 4)
    newest = B.newest_in_buckets(spark, "b_typed")
    assert "Exchange" not in plan_of(newest) and rows_of(newest) == rows_of(D.dedupe_full(typed))
    B.write_bucketed(typed, "b_newest", str(folder / "newest"), 4, newest=True)
    assert spark.table("b_newest").count() == 1020
    first = SV.serving_projection(D.dedupe_full(TY.fixture_typed(X.ota_raw(spark, SF_SMALL, (X.DELIVERY_A,)))))
    whole = SV.serving_projection(D.dedupe_full(typed))
    for name, rows in (("b_old", first), ("b_new", whole)):
        B.write_bucketed(rows, name, str(folder / name), 4, S.SERVING_KEY)
    merged = B.upsert_in_buckets(spark, "b_old", "b_new")
    assert "Exchange" not in plan_of(merged)
    assert rows_of(merged) == rows_of(SV.upsert(first, whole))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    for name in ("b_typed", "b_newest", "b_old", "b_new"):
        spark.sql(f"DROP TABLE {name}")


# --- day files: join, stream -----------------------------------------------------


def test_a_join_with_days_reads_only_their_entries(spark, folder):
    from eventlake.sources import landing as L

    raw = X.bulk_raw(spark, SF_SMALL)
    L.write_day_files(L.split_plan(raw), str(folder / "landing"))
    (folder / "landing" / "day_file=20240120_OTA.parquet" / "part-corrupt.parquet").write_bytes(b"not parquet")
    L.landing_table(spark, "landed_days", str(folder / "landing"), raw.schema)
    got = L.range_of_table(spark, "landed_days", "2024-01-10", "2024-01-12")
    n = got.count()
    assert n == L.read_range(spark, str(folder / "landing"), "2024-01-10", "2024-01-12").count() > 0
    assert "dynamicpruning" in plan_of(got)
    assert L.range_of_table(spark, "landed_days", "2023-01-10", "2023-01-12").count() == 0
    assert L.range_of_table(spark, "landed_days", "2024-01-12", "2024-01-10").count() == 0
    with pytest.raises(Exception):
        spark.table("landed_days").select("request_id").where("request_id > ''").collect()
    spark.sql("DROP TABLE landed_days")


def test_a_stream_lands_each_file_once(spark, folder):
    from eventlake.sources import landing as L
    from eventlake.streaming import landing as SL

    schema = "request_id string, timestamp bigint"
    put = lambda name, n: spark.range(n).selectExpr(f"concat('{name}', id) AS request_id", "id AS timestamp").coalesce(1).write.parquet(str(folder / "in" / name))
    run = lambda **k: SL.land_new(spark, str(folder / "in"), str(folder / "out"), str(folder / "state"), schema, **k)
    put("20240101_OTA.parquet", 3)
    put("20240102_XYZ.parquet", 9)
    assert run() == ["20240101_OTA.parquet"]
    assert run() == []
    put("sub/20240103_OTA.parquet", 4)
    put("sub/20240101_OTA.parquet", 5)  # that entry is landed already
    assert run() == ["20240103_OTA.parquet"]
    rows = spark.read.parquet(str(folder / "out")).groupBy(L.DAY_FILE).count().collect()
    assert {r[0]: r[1] for r in rows} == {"20240101_OTA.parquet": 3, "20240103_OTA.parquet": 4}
    put("more/20240101_OTA.parquet", 6)
    assert run(replace=True) == ["20240101_OTA.parquet"]
    assert spark.read.parquet(str(folder / "out")).count() == 10
    # a batch lost after its write lands nothing twice when it runs again
    again = SL._land(str(folder / "out"), "OTA", False, told := [])
    again(spark.read.parquet(str(folder / "out")), 0)
    assert told == [] and spark.read.parquet(str(folder / "out")).count() == 10


def test_a_stream_opens_only_files_to_be_landed(spark, folder):
    from eventlake.sources import landing as L
    from eventlake.streaming import landing as SL

    put = lambda path: spark.range(3).selectExpr("CAST(id AS STRING) AS request_id").coalesce(1).write.parquet(str(folder / "in" / path))
    run = lambda: SL.land_new(spark, str(folder / "in"), str(folder / "out"), str(folder / "state"), "request_id string")
    put("a [1]{x}*?/day_file=20240101_OTA.parquet")
    assert run() == ["20240101_OTA.parquet"]
    for name in ("20240101_OTA.parquet", "20240102_XYZ.parquet"):  # landed already; another suffix
        (folder / "in" / name).write_bytes(b"not parquet")
    put("day_file=20240103_OTA.parquet")
    assert run() == ["20240103_OTA.parquet"]
    rows = spark.read.parquet(str(folder / "out")).groupBy(L.DAY_FILE).count().collect()
    assert {r[0]: r[1] for r in rows} == {"20240101_OTA.parquet": 3, "20240103_OTA.parquet": 3}


def test_entry_names_as_by_pattern(spark):
    from eventlake.sources import landing as L

    parts = ["", "a", "k=v", "=", "=b", "a=b=c", "x.parquet", ".parquet", "k=.parquet", "k=x.parquet", "a=b=x.parquet", "=x.parquet", "x.parquet.parquet", "ü=ö.parquet"]
    paths = [*parts, *("/".join(p) for p in itertools.product(parts, repeat=2)), *("/".join(p) for p in itertools.product(parts, repeat=3)), "s3://b/k=1/20240101_OTA.parquet"]

    def by_pattern(p):
        if inside := re.search(r"(?:[^/=]+=)?([^/=]+\.parquet)/[^/]+$", p):
            return inside[1]
        own = re.search(r"([^/]+)/?$", p)
        return re.sub(r"^[^=]+=", "", own[1] if own else "")

    rows = spark.createDataFrame([(p,) for p in [*paths, None]], "path string")
    got = {r[0]: r[1] for r in rows.select("path", L.entry_name("path")).collect()}
    assert got == {p: by_pattern(p) for p in paths} | {None: None}
    assert "regexp" not in plan_of(rows.select(L.entry_name("path")))


# --- scripts ---------------------------------------------------------------------


def test_statements_are_cut_at_semicolons_outside_quotes():
    text = "SELECT 'a;b' AS x; -- c; d\nSELECT `;` FROM t /* ; */;\n\n-- only a remark;\n;SELECT \"it\\\";s\""
    assert [s.split("\n")[-1] for s in TB.statements(text)] == ["SELECT 'a;b' AS x", "SELECT `;` FROM t /* ; */", 'SELECT "it\\";s"']


def test_a_script_reports_each_statement(spark, folder):
    script = """
    DECLARE most INT DEFAULT :most;
    CREATE TABLE s_rows (id INT) USING parquet;
    INSERT INTO s_rows SELECT id FROM {ids} WHERE id < most;
    INSERT INTO s_rows SELECT id + 100 FROM {ids} WHERE id >= most AND 'a;' <> 'b';
    SELECT count(*) AS n FROM s_rows;
    """
    ids = spark.range(10).selectExpr("CAST(id AS INT) AS id")
    df, told = TB.run_script(spark, script, {"most": 4}, ids=ids)
    assert df.first()["n"] == 10
    assert [(t["statement"], t["kind"], t["state"], t["rows"]) for t in told] == [
        (1, "DECLARE", "DONE", None), (2, "CREATE", "DONE", None), (3, "INSERT", "DONE", 4), (4, "INSERT", "DONE", 6), (5, "SELECT", "DONE", 1)]
    bad = "INSERT INTO s_rows SELECT 1; INSERT INTO s_rows SELECT CAST('x' AS INT); INSERT INTO s_rows SELECT 2"
    with pytest.raises(TB.ScriptFailed, match="statement 2") as e:
        TB.run_script(spark, bad)
    assert [(t["statement"], t["state"], t["rows"]) for t in e.value.summary] == [(1, "DONE", 1), (2, "FAILED", None)]
    assert spark.table("s_rows").count() == 11
    with pytest.raises(Exception):
        spark.sql("SELECT most")  # the script's variable is gone
    spark.sql("DROP TABLE s_rows")


# --- runs ------------------------------------------------------------------------


def test_runs_keep_the_catalog_and_reach_back(spark, folder):
    from datetime import timedelta

    from eventlake.plans import runs as RUNS
    from eventlake.sources import landing as L

    lay = RUNS.Layout(**{k: str(folder / k) for k in ("landing", "typed", "deduped", "serving", "cursor")}, catalog="kept_up")
    bulk = X.bulk_raw(spark, SF_SMALL)
    days = bulk.where(F.expr("timestamp < unix_micros(timestamp'2024-01-04') * 1000"))
    L.write_day_files(L.split_plan(days.where("request_id <> 'r0'")), lay.landing)
    out = RUNS.recent(spark, lay, "2024-01-01", "2024-01-02")
    assert out["catalog"] == ["kept_up.typed", "kept_up.deduped"]
    n = lambda: (spark.table("kept_up.typed").count(), spark.table("kept_up.deduped").count())
    before = n()
    assert before == (TB.read_table(spark, lay.typed).count(), TB.read_table(spark, lay.deduped).count())
    RUNS.recent(spark, lay, "2024-01-03", "2024-01-03")
    assert n()[0] == TB.read_table(spark, lay.typed).count() > before[0]
    # rows that come late, with times before the cursor
    served = spark.read.parquet(lay.serving).count()
    L.write_day_files(L.split_plan(days), lay.landing)
    late = TB.read_table(spark, lay.typed).count()
    RUNS.recent(spark, lay, today=date(2024, 1, 3), lookback=timedelta(days=3))
    assert TB.read_table(spark, lay.typed).count() > late
    assert spark.read.parquet(lay.serving).count() > served
    for name in out["catalog"]:
        spark.sql(f"DROP TABLE {name}")
