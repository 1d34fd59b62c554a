"""Typed and deduplicated tables: create, append, replace a day range, refresh.

Each operation has a pure form (DataFrame in, DataFrame out: what the table
holds afterwards) and a storage form on a Parquet table partitioned by
``source_day``, clustered inside each day by event_date, country,
page_name, hotel_id, funnel_id (row-group statistics then prune on them).

Plain Parquet has no DELETE or MERGE, so a range replace is a dynamic
partition overwrite with the batch followed by dropping the range's days
that the batch does not contain. Rows with a NULL ``source_day`` live in
the default partition, outside every range, and are never touched.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.functions import ranges as R
from eventlake.operators.dedupe import Touched, in_day_range, key_match

WRITE_APPEND = "WRITE_APPEND"
WRITE_TRUNCATE = "WRITE_TRUNCATE"
WRITE_EMPTY = "WRITE_EMPTY"
CREATE_IF_NEEDED = "CREATE_IF_NEEDED"
CREATE_NEVER = "CREATE_NEVER"


# --- pure forms ----------------------------------------------------------------


def in_table_order(df: DataFrame) -> DataFrame:
    """The 32 table columns, by name, in table order (extra columns dropped)."""
    return df.select(*S.TYPED_COLUMNS)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The table after appending a batch (a re-run appends again)."""
    return in_table_order(target).unionByName(in_table_order(batch))


def replace_range(target: DataFrame, batch: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """The table after deleting the range's days and inserting the
    batch's rows of the range. Days of the range without incoming rows end
    up empty; NULL days are neither deleted nor inserted."""
    kept = in_table_order(target).where(~in_day_range(S.DAY_PARTITION, start, end))
    fresh = in_table_order(batch).where(in_day_range(S.DAY_PARTITION, start, end))
    return kept.unionByName(fresh)


def refresh(batch: DataFrame) -> DataFrame:
    """The table after a full refresh: exactly the batch."""
    return in_table_order(batch)


# --- storage forms -------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@contextmanager
def staged(df: DataFrame, label: str = "stage"):
    """Write a DataFrame to the shared staging folder and read it back, for the
    span of a ``with`` block; the files go when it ends (after the writes that
    consume them committed). This cuts the lineage: the result no longer
    reads the tables the plan came from, so it may overwrite them, and a
    lost executor recomputes from the staged files."""
    spark = df.sparkSession
    path = f"{SESSION.staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    try:
        df.write.mode("errorifexists").parquet(path)
        yield spark.read.parquet(path)
    finally:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            fs.delete(p, True)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared staging folder and read it. The files stay,
    as the lazy result that reads them needs them; the cluster's clean-up of that
    folder removes them. What must be evaluated once (counts that bound a
    later filter, range partitions whose limits are sampled) goes through here."""
    spark = df.sparkSession
    path = f"{SESSION.staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _beside(path: str, label: str) -> str:
    return f"{path.rstrip('/')}__{label}"


def write_pending(rows: DataFrame, path: str) -> None:
    """Write rows that are to replace partitions of the table at ``path`` in
    full beside it; ``redo`` puts them in place."""
    rows.write.mode("overwrite").parquet(_beside(path, "pending"))


def redo(spark: SparkSession, path: str, apply) -> bool:
    """Put a complete pending replacement in place and remove it; an incomplete
    one (its write was interrupted) is removed. Doing it twice is the same as
    once, so a run that was lost in the middle is finished by the next."""
    pending = _beside(path, "pending")
    fs, p = _fs(spark, pending)
    if not fs.exists(p):
        return False
    whole = fs.exists(_fs(spark, f"{pending}/_SUCCESS")[1])
    if whole:
        apply(spark.read.parquet(pending))
    fs.delete(p, True)
    return whole


def ensure_table(
    spark: SparkSession, name: str, location: str, schema=S.TYPED_SCHEMA, partition: str = S.DAY_PARTITION
) -> None:
    """Create the database and the partitioned table if absent."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({S.ddl(schema)}) USING parquet "
        f"PARTITIONED BY (`{partition}`) LOCATION '{location}'"
    )


def sync_table(spark: SparkSession, name: str) -> None:
    """Make a catalog table over a path see the day partitions written or
    dropped by the path-based operators here (partition metadata only)."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def _clustered(df: DataFrame, rebalance: bool) -> DataFrame:
    out = in_table_order(df)
    if rebalance:
        # AQE sizes the write tasks and splits a hot day over several of them
        out = out.hint("rebalance", S.DAY_PARTITION)
    return out.sortWithinPartitions(S.DAY_PARTITION, *S.CLUSTER_COLUMNS)


def _overwrite_days(rows: DataFrame, path: str, rebalance: bool) -> None:
    """Replace exactly the day partitions that ``rows`` hold."""
    (
        _clustered(rows, rebalance)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(S.DAY_PARTITION)
        .parquet(path)
    )


def write_append(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """S12 on storage: append a batch to the table at ``path``."""
    (
        _clustered(df, rebalance)
        .write.mode("append")
        .partitionBy(S.DAY_PARTITION)
        .parquet(path)
    )


def write_replace_range(
    batch: DataFrame, path: str, start: date | str, end: date | str, rebalance: bool = True
) -> dict:
    """S13/S14 on storage: replace the range's days of the table at ``path``.

    The batch's rows of the range overwrite their day partitions (dynamic
    overwrite), then days of the range the batch did not hold are dropped.
    The days written are observed during the write itself (at most one
    value per day of the range), so the batch is computed once. A batch may
    read the table it replaces: dynamic overwrite writes to a staging folder
    and swaps days in only when every task has finished.
    """
    spark = batch.sparkSession
    start_d, end_d = R.parse_day(start), R.parse_day(end)
    fresh = batch.where(in_day_range(S.DAY_PARTITION, start_d, end_d))
    seen = Observation("replace_range")
    observed = fresh.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(S.DAY_PARTITION).alias("days"))
    _overwrite_days(observed, path, rebalance)
    metrics = seen.get
    written = {d for d in metrics["days"]}
    dropped = drop_days(spark, path, [d for d in _days(start_d, end_d) if d not in written])
    return {"rows": metrics["rows"], "days_written": sorted(written), "days_emptied": dropped}


def write_replace_keys(
    winners: DataFrame, touched: Touched, path: str, rebalance: bool = True, changing: Callable[[list[date]], None] = lambda days: None,
) -> dict:
    """D2 ``scope="keys"`` on storage: every row of the given event keys,
    whichever day it sits in, is replaced by the keys' new winners.

    Every row of the touched keys has its timestamp in their span. The days to rewrite are those of the
    keys' old rows (found by a semi join on the time-narrowed table) and of
    the winners (observed while staging them); only those day partitions
    are read and written again (dynamic overwrite), and days left without
    rows are dropped. ``changing`` is told the days before any is written.
    """
    spark = winners.sparkSession
    redo(spark, path, lambda rows: _overwrite_days(rows, path, rebalance))
    seen = Observation("replace_keys")
    observed = in_table_order(winners).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(S.DAY_PARTITION).alias("days"),
        F.max(F.col(S.DAY_PARTITION).isNull().cast("int")).alias("null_day"),
    )
    with staged(observed, "keys-new") as fresh:
        metrics = seen.get
        old = read_table(spark, path)
        old_days = [
            r[0]
            for r in old.where(touched.in_span()).join(touched.keys, on=key_match(), how="left_semi")
            .select(S.DAY_PARTITION).distinct().collect()  # one row per day
        ]
        days = sorted({d for d in old_days if d is not None} | set(metrics["days"]))
        null_day = None in old_days or bool(metrics["null_day"])
        day = F.col(S.DAY_PARTITION)
        chosen = day.isin(days) | (day.isNull() & F.lit(null_day))
        kept = old.where(chosen).join(touched.keys, on=key_match(), how="left_anti")
        rebuilt = in_table_order(kept).unionByName(fresh)
        changing(days)
        write_pending(rebuilt, path)
    left = set()

    def swap(rows: DataFrame) -> None:
        written = Observation("replace_keys_write")
        _overwrite_days(rows.observe(written, F.collect_set(S.DAY_PARTITION).alias("days")), path, rebalance)
        left.update(written.get["days"])

    redo(spark, path, swap)
    emptied = drop_days(spark, path, [d for d in days if d not in left])
    return {"rows": metrics["rows"], "days_rewritten": days, "days_emptied": emptied}


def _days(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def drop_days(spark: SparkSession, path: str, days: list[date]) -> list[date]:
    """Delete day partitions of a table (ALTER TABLE DROP PARTITION on a path table)."""
    fs, _ = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    gone = []
    for d in days:
        part = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{S.DAY_PARTITION}={d.isoformat()}")
        if fs.exists(part):
            fs.delete(part, True)
            gone.append(d)
    return gone


def write_refresh(df: DataFrame, path: str, rebalance: bool = True) -> None:
    """S15 on storage: replace the whole table.

    The new version is written in full beside the old one, which stays
    readable meanwhile (``df`` may read it), and takes its place by two
    renames. ``finish_refresh`` completes a switch that was interrupted.
    """
    spark = df.sparkSession
    finish_refresh(spark, path)
    new = _beside(path, "new")
    _clustered(df, rebalance).write.mode("overwrite").partitionBy(S.DAY_PARTITION).parquet(new)
    finish_refresh(spark, path)


def finish_refresh(spark: SparkSession, path: str) -> None:
    """Switch to a complete new version of a table, if there is one. Each step
    can be repeated: old aside, new in place, old removed."""
    fs, here = _fs(spark, path)
    new, old = (_fs(spark, _beside(path, label))[1] for label in ("new", "old"))
    if fs.exists(new) and fs.exists(_fs(spark, f"{_beside(path, 'new')}/_SUCCESS")[1]):
        if fs.exists(here):
            if fs.exists(old):
                fs.delete(old, True)
            fs.rename(here, old)
        fs.rename(new, here)
    if fs.exists(old) and fs.exists(here):
        fs.delete(old, True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A typed/deduplicated table, columns in table order (after a switch of
    versions that an earlier run did not complete)."""
    finish_refresh(spark, path)
    return in_table_order(spark.read.schema(S.TYPED_SCHEMA).parquet(path))


# --- S16: SQL text into a table -----------------------------------------------


def sql_source(spark: SparkSession, sql: str, folder: str | None = None) -> str:
    """The statement text: ``sql`` itself or, when it names a ``.sql`` file, the
    file's content, read by Spark so that any file system will do. A name
    that is not a full path is looked up in ``folder``."""
    name = (sql or "").strip()
    if not name[-4:].lower() == ".sql":
        return name
    full = name if folder is None or name.startswith("/") or "://" in name else f"{folder.rstrip('/')}/{name}"
    fs, path = _fs(spark, full)
    if not fs.exists(path):
        raise FileNotFoundError(f"no SQL script at {full}")
    return spark.read.text(full, wholetext=True).first()[0].strip()


def run_sql(
    spark: SparkSession,
    sql: str,
    args: dict | None = None,
    destination: str | None = None,
    write_disposition: str = WRITE_APPEND,
    create_disposition: str = CREATE_IF_NEEDED,
    base_dir: str | None = None,
    location: str | None = None,
    **frames: DataFrame,
) -> tuple[DataFrame, dict]:
    """Run parameterized SQL, optionally into a destination table.

    Text of several statements runs as one Spark SQL script (DECLARE, SET,
    CREATE, INSERT ...; variables live in the script); its result is that of
    the last statement. Values are bound as named parameters (``:name``),
    table names with ``IDENTIFIER(:name)``, DataFrames as ``{name}``
    references. Returns the result and a summary (state, destination, rows):
    the rows written to the destination, or else those of the result.
    ``location`` makes a created destination an external table there.
    """
    text = sql_source(spark, sql, base_dir).rstrip().rstrip(";")
    if ";" in text and text.split(None, 1)[0].upper() != "BEGIN":
        text = f"BEGIN\n{text};\nEND"
    df = spark.sql(text, args=args or None, **frames)
    summary = {"state": "DONE", "destination": destination, "rows": None}
    if destination is None:
        summary["rows"] = df.count()
        return df, summary
    if "." in destination and create_disposition == CREATE_IF_NEEDED:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{destination.rsplit('.', 1)[0]}`")
    present = spark.catalog.tableExists(destination)
    if not present and create_disposition == CREATE_NEVER:
        raise ValueError(f"destination {destination} does not exist")
    modes = {WRITE_APPEND: "append", WRITE_TRUNCATE: "overwrite", WRITE_EMPTY: "append"}
    if write_disposition not in modes:
        raise ValueError(f"unknown write disposition {write_disposition}")
    if write_disposition == WRITE_EMPTY and present and not spark.table(destination).isEmpty():
        raise ValueError(f"destination {destination} is not empty")
    seen = Observation("sql_to_table")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(modes[write_disposition])
    (writer.option("path", location) if location else writer).saveAsTable(destination)
    summary["rows"] = seen.get["rows"]
    return spark.table(destination), summary


class ScriptFailed(RuntimeError):
    """A statement of a script failed; ``summary`` tells which, and what the
    statements before it did."""

    def __init__(self, message: str, summary: list[dict]):
        super().__init__(message)
        self.summary = summary


# What may stand in a statement with a semicolon in it: text, names, comments.
_QUOTED = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
_PART = re.compile(rf"(?:{_QUOTED}|[^;])+", re.S)


def statements(script: str) -> list[str]:
    """The statements of a script, separated by semicolons."""
    parts = [p.strip() for p in _PART.findall(script)]
    return [p for p in parts if re.sub(r"--[^\n]*|/\*.*?\*/", "", p, flags=re.S).strip()]


def _rows_written(df: DataFrame) -> int | None:
    """Rows that a command wrote, as Spark's metrics of it say."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() != "CommandResultExec":
        return None
    pending = [plan.commandPhysicalPlan()]
    while pending:
        node = pending.pop()
        found = node.metrics().get("numOutputRows")
        if found.isDefined():
            return int(found.get().value())
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
    return None


def run_script(spark: SparkSession, script: str, args: dict | None = None, base_dir: str | None = None, **frames: DataFrame) -> tuple[DataFrame | None, list[dict]]:
    """Run the statements of a script (or ``.sql`` file) one by one, with a
    summary of each: number, first word, state, rows (written by a command,
    returned by a query). ``DECLARE`` makes variables that later statements see;
    they end with the script. Returns the last query's result.

    If statement k fails, ``ScriptFailed`` names k; its summary has the counts of
    the statements before it, which stay done."""
    text = sql_source(spark, script, base_dir)
    summary: list[dict] = []
    result, declared = None, []
    try:
        for k, statement in enumerate(statements(text), 1):
            words = re.sub(r"--[^\n]*|/\*.*?\*/", " ", statement, flags=re.S).split()
            entry = {"statement": k, "kind": words[0].upper(), "state": "RUNNING", "rows": None}
            summary.append(entry)
            try:
                if entry["kind"] == "DECLARE":
                    names = [w for w in words[1:] if w.upper() not in ("OR", "REPLACE", "VARIABLE")]
                    declared.append(names[0])
                df = spark.sql(statement, args=args or None, **frames)
                if df.columns and df._jdf.queryExecution().executedPlan().getClass().getSimpleName() != "CommandResultExec":
                    entry["rows"], result = df.count(), df
                else:
                    entry["rows"] = _rows_written(df)
            except Exception as e:
                entry.update(state="FAILED", error=str(e).split("\n")[0])
                raise ScriptFailed(f"statement {k} ({entry['kind']}) failed: {entry['error']}", summary) from e
            entry["state"] = "DONE"
        return result, summary
    finally:
        for name in declared:
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {name}")
