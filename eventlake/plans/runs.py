"""The two runs, end to end, on storage; and the recent run as one pure plan.

*Recent*: resolve the range once; stop cleanly if no day file of the range
exists; replace the range in the typed table, then in the deduplicated
table; load into the serving table from the cursor (a given start date
backfills from its midnight).

*Historic*: split the bulk file into day files, land them, append them all
to the typed table, rebuild the deduplicated table, load.

Each step is one Spark job (or two, where a staged intermediate is needed);
the driver only resolves parameters, lists day entries and moves day
directories.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.functions import ranges as R
from eventlake.operators import day_filters as DF
from eventlake.operators import dedupe as D
from eventlake.operators import serve as SV
from eventlake.operators import tables as TB
from eventlake.operators import typed as TY
from eventlake.sources import landing as L


@dataclass(frozen=True)
class Layout:
    """Where the tables of one deployment live (any Hadoop file system)."""

    landing: str
    typed: str
    deduped: str
    serving: str
    cursor: str
    rejects: str | None = None
    suffix: str = S.DEFAULT_SUFFIX
    catalog: str | None = None  # database that names the typed and deduplicated tables


# --- the load -----------------------------------------------------------------------


def load(spark: SparkSession, layout: Layout, cursor: SV.Cursor, lookback: timedelta | None = None) -> dict:
    """U1..U5: deduplicated rows after the cursor -> serving table; then the cursor.

    Days whose newest event is known to be before the cursor are not read (partition
    filter from the day statistics kept beside the cursor); ``lookback``
    reaches back for late rows. Rejected rows go to ``layout.rejects`` when
    given, in a partition named by the load's start (a re-run of the same
    load replaces it). The cursor moves to the max timestamp loaded, and only
    after the serving table committed.
    """
    deduped = TB.read_table(spark, layout.deduped)
    reach = replace(cursor, ts=cursor.ts - lookback) if lookback else cursor
    days = SV.days_after(spark, day_stats(layout), reach)
    sliced = SV.after_cursor(deduped if days is None else deduped.where(days), cursor, lookback)
    if layout.rejects:
        SV.write_rejects(sliced, layout.rejects, cursor.ts.isoformat())
    result = SV.write_upsert(SV.serving_projection(sliced), layout.serving)
    if result["rows"]:
        new_cursor = max(result["max_timestamp"].replace(tzinfo=timezone.utc), cursor.ts)
        SV.write_cursor(spark, layout.cursor, new_cursor)
        result["cursor"] = new_cursor.isoformat()
    else:
        result["cursor"] = cursor.ts.isoformat()
    return result


def day_stats(layout: Layout) -> str:
    return f"{layout.cursor.rstrip('/')}__days"


def publish(spark: SparkSession, layout: Layout) -> list[str]:
    """The typed and the deduplicated table in the catalog, created if
    absent, with the partitions that the run wrote or dropped."""
    names = []
    for name, path in (("typed", layout.typed), ("deduped", layout.deduped)) if layout.catalog else ():
        names.append(f"{layout.catalog}.{name}")
        TB.ensure_table(spark, names[-1], path)
        TB.sync_table(spark, names[-1])
    return names


def typed_entries(spark: SparkSession, paths: list[str], suffix: str, loaded_at: datetime | None) -> DataFrame:
    """Typed rows of day entries; entries of differing types are typed apart."""
    out = None
    for raw in L.read_entries(spark, paths):
        # source_file (added by the reader) rather than _metadata.file_path: the
        # scan then needs no Parquet row index (checked with explain)
        typed = TY.typed_events(raw, suffix=suffix, file_path="source_file", ingested_at=loaded_at)
        out = typed if out is None else out.unionByName(typed)
    return out


# --- recent ----------------------------------------------------------------------------


def recent(
    spark: SparkSession,
    layout: Layout,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    today: date | None = None,
    loaded_at: datetime | None = None,
    scope: str = "range",
    lookback: timedelta | None = None,
) -> dict:
    """The recent run. Returns a status dict; ``status`` is ``no_data`` when
    the range has no day file (nothing downstream runs then).

    ``scope="range"`` deduplicates the range's rows and replaces the range's
    days in the deduplicated table, as the original job does (copies of an
    event outside the range are not seen). ``scope="keys"`` re-deduplicates
    every event key the range touches over all its copies and replaces
    those keys wherever they sit, so the deduplicated table stays equal to a
    full rebuild. ``lookback`` lets the load reach back behind its cursor, for
    rows whose time is before what was loaded last.
    """
    if scope not in ("range", "keys"):
        raise ValueError(f"unknown scope {scope!r}")
    SESSION.configure(spark)
    start, end = R.resolve_range(start_date, end_date, today)
    status: dict = {"range": [start.isoformat(), end.isoformat()]}
    entries = L.range_entries(spark, layout.landing, R.days_between(start, end), layout.suffix)
    files = [name for name, _ in entries]
    if not files:
        status["status"] = "no_data"
        return status
    status["files"] = files
    typed = typed_entries(spark, [path for _, path in entries], layout.suffix, loaded_at)
    DF.forget(spark, layout.typed, R.days_between(start, end))
    status["typed"] = TB.write_replace_range(typed, layout.typed, start, end, rebalance=False)
    typed_now = TB.read_table(spark, layout.typed)
    if scope == "range":
        batch = D.dedupe_range(typed_now, start, end)
        SV.forget_days(spark, day_stats(layout), R.days_between(start, end))
        status["deduped"] = TB.write_replace_range(batch, layout.deduped, start, end)
    else:
        fs, root = TB._fs(spark, layout.deduped)
        before = TB.read_table(spark, layout.deduped) if fs.exists(root) else None
        touched = D.touched_keys(typed_now, start, end, also=before)
        if touched is not None:
            DF.build(spark, layout.typed, R.days_between(start, end))
            # only days that may hold a copy of a touched event are read
            requests = touched.keys.select(F.col(f"{D.KEY_PREFIX}{DF.KEY}").alias(DF.KEY))
            near = typed_now.where(DF.may_hold(spark, layout.typed, requests))
            status["deduped"] = TB.write_replace_keys(
                D.winners_of(near, touched), touched, layout.deduped,
                changing=lambda days: SV.forget_days(spark, day_stats(layout), days),
            )
    changed = status.get("deduped", {}).get("days_rewritten") or R.days_between(start, end)
    SV.write_day_stats(spark, TB.read_table(spark, layout.deduped), day_stats(layout), changed)
    status["catalog"] = publish(spark, layout)
    given_start = R.parse_day(start_date)
    cursor = SV.cursor_start(override=given_start, stored=SV.read_cursor(spark, layout.cursor))
    status["load"] = load(spark, layout, cursor, lookback)
    status["status"] = "done"
    return status


def recent_plan(
    typed_before: DataFrame, deduped_before: DataFrame, serving_before: DataFrame, batch_raw_typed: DataFrame,
    start: date | str, end: date | str, cursor: SV.Cursor,
) -> DataFrame:
    """The recent run as one plan: the serving table it leaves behind.

    ``batch_raw_typed`` are the typed rows of the range's day files.
    """
    typed_after = TB.replace_range(typed_before, batch_raw_typed, start, end)
    deduped_after = TB.replace_range(deduped_before, D.dedupe_range(typed_after, start, end), start, end)
    return SV.upsert(serving_before, SV.serving_projection(SV.after_cursor(deduped_after, cursor)))


# --- historic ---------------------------------------------------------------------------


def land(
    spark: SparkSession,
    source_folder: str,
    landing: str,
    skip_if_exists: bool = True,
    names: list[str] | None = None,
    date_start: str | None = None,
    date_end: str | None = None,
    suffix: str | None = None,
    recursive: bool = False,
    pattern: str = L.NAME_PATTERN,
) -> dict:
    """S6..S9: land the Parquet entries of a folder into the landing folder.

    The entries to land, whatever their names, are read and written by Spark
    in one job, each under its own name; entries already landed, and all but
    the first of several with one name, are skipped unless ``skip_if_exists``
    is off (then the last of them by path is what stays).
    """
    listing = L.list_entries(spark, source_folder, recursive)
    candidates = L.pick_files(listing, names, date_start, date_end, suffix, pattern)
    # a test for each candidate's name: what else the landing folder holds does not matter
    wanted = sorted({r[0] for r in candidates.select(L.NAME).collect()})  # a name a day
    there = [(n,) for n in wanted if any(L.exists(spark, f"{landing.rstrip('/')}/{p}{n}") for p in ("", f"{L.DAY_FILE}="))]
    landed = spark.createDataFrame(there, f"{L.NAME} string")
    plan = [r.asDict() for r in L.landing_plan(candidates, landed, skip_if_exists).collect()]  # one row per day
    todo = [r for r in plan if r["action"] == "uploaded"]
    # of several entries with one name the last by path is what a landing in order leaves
    last = {r[L.NAME]: r[L.PATH] for r in sorted(todo, key=lambda r: r[L.PATH])}
    for rows in L.read_entries(spark, sorted(last.values())) if todo else []:
        L.write_entries(rows.withColumn(L.DAY_FILE, L.entry_name("source_file")).drop("source_file"), landing)
    return {
        "uploaded": len(todo),
        "skipped": len(plan) - len(todo),
        "targets": sorted(f"{landing.rstrip('/')}/{r[L.NAME]}" for r in plan),
    }


def historic(
    spark: SparkSession,
    layout: Layout,
    bulk_path: str,
    start_ts: str | None = None,
    timestamp_col: str = "timestamp",
    loaded_at: datetime | None = None,
    export: str | None = None,
    lookback: timedelta | None = None,
) -> dict:
    """The historic run (S1 -> S2/S3 -> [S9] -> S5/S12 -> S15 -> load).

    With ``export`` the bulk file is split into that folder first and its
    day files are then landed, skipping days already landed (as the
    original split-then-upload does); without it the split writes straight
    into the landing folder, replacing the days it holds.
    """
    SESSION.configure(spark)
    status: dict = {}
    plan = L.split_plan(L.read_bulk(spark, bulk_path, timestamp_col), timestamp_col, layout.suffix)
    written = L.write_day_files(plan, export or layout.landing, layout.suffix)
    status["split"] = {"num_files": len(written), "files_sample": written[:10]}
    if export:
        status["land"] = land(spark, export, layout.landing, skip_if_exists=True)
    typed = typed_entries(spark, L.day_entries(spark, layout.landing, layout.suffix), layout.suffix, loaded_at)
    DF.forget(spark, layout.typed)
    TB.write_append(typed, layout.typed)
    SV.forget_days(spark, day_stats(layout))
    TB.write_refresh(D.dedupe_full(TB.read_table(spark, layout.typed)), layout.deduped)
    SV.write_day_stats(spark, TB.read_table(spark, layout.deduped), day_stats(layout))
    status["catalog"] = publish(spark, layout)
    cursor = SV.cursor_start(param=start_ts, stored=SV.read_cursor(spark, layout.cursor))
    status["load"] = load(spark, layout, cursor, lookback)
    status["status"] = "done"
    return status
