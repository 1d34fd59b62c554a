"""Incremental load of the deduplicated table into the serving table.

The original loop fetched 10,000 rows after a timestamp cursor, upserted
them one chunk at a time and moved the cursor. Here the load is one
distributed pass: slice after the cursor, narrow to serving types, split off
rows the serving table would reject, upsert by (request_id, timestamp),
then store the cursor (sink first, cursor second: at-least-once, made safe
by the keyed upsert).

The serving table is Parquet partitioned by ``event_date``; the key holds
``timestamp``, so a key's date follows from the key and an upsert rewrites
only the dates its rows touch.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.functions import cleaning as C
from eventlake.operators import tables as TB

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
PRIORITY = "_priority"
RANK = "_rn"
REASON = "reject_reason"
_DATE_ONLY = re.compile(r"\d{4}-\d{2}-\d{2}")


# --- P17..P19: serving projection and rejects ----------------------------------


def reject_reason_sql() -> str:
    """First serving constraint a typed row violates, NULL if none (SQL text)."""
    checks = [(f"{C.ident(c)} IS NULL", f"null {c}") for c in S.SERVING_NOT_NULL]
    narrowed = f"TRY_CAST(hotel_price AS {S.SERVING_PRICE_TYPE.simpleString()})"
    checks.append((f"hotel_price IS NOT NULL AND {narrowed} IS NULL", "hotel_price overflow"))
    checks += [(f"char_length({C.ident(c)}) > {n}", f"{c} too long") for c, n in S.SERVING_VARCHAR.items()]
    checks += [(f"octet_length({C.ident(c)}) > {n}", f"{c} too long") for c, n in S.SERVING_TEXT_BYTES.items()]
    return "CASE " + " ".join(f"WHEN {cond} THEN {C.text(label)}" for cond, label in checks) + " END"


def reject_reason() -> Column:
    """First serving constraint a typed row violates, NULL if none."""
    return F.expr(reject_reason_sql())


def serving_sql() -> list[str]:
    rules = {
        "timestamp": C.naive_utc_sql("`timestamp`"),
        "ingested_at": C.naive_utc_sql("ingested_at"),
        "hotel_price": f"TRY_CAST(hotel_price AS {S.SERVING_PRICE_TYPE.simpleString()})",
    }
    return C.projection_sql(S.TYPED_COLUMNS, rules)


def serving_projection(df: DataFrame) -> DataFrame:
    """Rows the serving table accepts, in serving types."""
    return df.where(f"({reject_reason_sql()}) IS NULL").selectExpr(*serving_sql())


def serving_rejects(df: DataFrame) -> DataFrame:
    """Rows the serving table would refuse, typed, with the reason."""
    cols = [C.ident(c) for c in S.TYPED_COLUMNS]
    return df.selectExpr(*cols, f"{reject_reason_sql()} AS {REASON}").where(f"{REASON} IS NOT NULL")


def write_rejects(df: DataFrame, path: str, load_from: str) -> int:
    """Rejects of one load as the partition ``load_from``; a load that runs again
    replaces its own, also when it has none any more. Returns their number."""
    seen = Observation("rejects")
    (
        serving_rejects(df)
        .withColumn("load_from", F.lit(load_from))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_from")
        .parquet(path)
    )
    rows = seen.get["rows"]
    if not rows:
        fs, root = TB._fs(df.sparkSession, path)
        for st in fs.listStatus(root) if fs.exists(root) else []:
            if unquote(st.getPath().getName()) == f"load_from={load_from}":
                fs.delete(st.getPath(), True)
    return rows


# --- U2, U6, P20: the cursor ---------------------------------------------------


@dataclass(frozen=True)
class Cursor:
    ts: datetime  # aware, UTC
    inclusive: bool
    source: str  # param | override | state | epoch


def parse_instant(text: str) -> datetime:
    """P20: ISO-8601 text -> aware UTC datetime; ``Z`` allowed, no offset = UTC."""
    try:
        ts = datetime.fromisoformat(str(text).strip())
    except ValueError as e:
        raise ValueError(f"invalid timestamp {text!r}: use ISO 8601") from e
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)


def _given(v) -> bool:
    return v is not None and str(v).strip() != ""


def cursor_start(param=None, override=None, stored=None) -> Cursor:
    """Run parameter, else operator override, else stored cursor, else epoch.

    A date-only override (a backfill from a start date) starts at midnight
    UTC *inclusive*, so an event at exactly 00:00:00 is loaded too.
    """
    for value, source in ((param, "param"), (override, "override")):
        if not _given(value):
            continue
        if isinstance(value, date) and not isinstance(value, datetime):
            return Cursor(datetime(value.year, value.month, value.day, tzinfo=timezone.utc), True, source)
        if isinstance(value, datetime):
            ts = value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)
            return Cursor(ts, False, source)
        text = str(value).strip()
        return Cursor(parse_instant(text), bool(_DATE_ONLY.fullmatch(text)), source)
    if _given(stored):
        ts = stored if isinstance(stored, datetime) else parse_instant(stored)
        ts = ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)
        return Cursor(ts, False, "state")
    return Cursor(EPOCH, False, "epoch")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a small state folder, oldest first."""
    fs, root = TB._fs(spark, path)
    if not fs.exists(root):
        return []
    names = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory())
    return [n for n in names if n.startswith("v") and fs.exists(TB._fs(spark, f"{path}/{n}/_SUCCESS")[1])]


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The newest complete version of a state folder, None when there is none."""
    versions = _versions(spark, path.rstrip("/"))
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{versions[-1]}") if versions else None


def write_state(df: DataFrame, path: str) -> None:
    """Store a new version beside the old one; an interrupted write leaves the
    old version in force. Versions before the last two are removed."""
    spark, path = df.sparkSession, path.rstrip("/")
    versions = _versions(spark, path)
    number = int(versions[-1][1:]) + 1 if versions else 0
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/v{number:012d}")
    for old in versions[:-1]:
        fs, p = TB._fs(spark, f"{path}/{old}")
        fs.delete(p, True)


CURSOR_SCHEMA = "cursor_us bigint"


def read_cursor(spark: SparkSession, path: str) -> datetime | None:
    """Stored cursor, None when there is none yet. It is kept as microseconds,
    so the driver's time zone does not matter."""
    state = read_state(spark, path, CURSOR_SCHEMA)
    us = state.agg(F.max("cursor_us")).first()[0] if state is not None else None
    return None if us is None else EPOCH + timedelta(microseconds=us)


def write_cursor(spark: SparkSession, path: str, ts: datetime) -> None:
    """Store the cursor (after the sink has committed)."""
    aware = ts if ts.tzinfo else ts.replace(tzinfo=timezone.utc)
    write_state(spark.range(1).select(F.lit((aware - EPOCH) // timedelta(microseconds=1)).cast("long").alias("cursor_us")), path)


DAYS_SCHEMA = "source_day date, max_us bigint"


def forget_days(spark: SparkSession, path: str, days: list[date] | None = None) -> None:
    """Mark days as unknown (all days without ``days``), before they are replaced:
    a run that is lost before it has stored their new times leaves them to be
    read."""
    old = read_state(spark, path, DAYS_SCHEMA)
    if old is None:
        return
    if days is None:
        write_state(old.limit(0), path)
        return
    # a row a day
    gone = spark.createDataFrame([(d, None) for d in days], DAYS_SCHEMA)
    write_state(old.where(~F.col("source_day").isin(days)).unionByName(gone), path)


def write_day_stats(spark: SparkSession, deduped: DataFrame, path: str, days: list[date] | None = None) -> None:
    """Keep the newest event time of each day of the deduplicated table; with
    ``days`` only those, and days that an earlier run left unknown, are read anew
    (by partition), the others stay."""
    day = F.col(S.DAY_PARTITION)
    old = read_state(spark, path, DAYS_SCHEMA) if days is not None else None
    if old is None or old.isEmpty():
        days = None
    else:
        days = sorted({*days, *(r[0] for r in old.where("max_us IS NULL").select("source_day").collect())})
    rows = deduped if days is None else deduped.where(day.isin(days))
    fresh = rows.where(day.isNotNull()).groupBy(day.alias("source_day")).agg(F.max(F.unix_micros("timestamp")).alias("max_us"))
    # a day whose rows all lack a time has nothing that any cursor could reach
    fresh = fresh.withColumn("max_us", F.coalesce("max_us", F.lit(-(1 << 62))))
    if days is not None:
        fresh = old.where(~F.col("source_day").isin(days)).unionByName(fresh)
    write_state(fresh, path)


def days_after(spark: SparkSession, path: str, cursor: Cursor) -> Column | None:
    """Partition filter for the rows a load may need: all but the days whose
    newest event is known to be before the cursor. Days that the statistics do
    not name, or name without a time, are read. None without statistics."""
    stats = read_state(spark, path, DAYS_SCHEMA)
    if stats is None:
        return None
    start = (cursor.ts - EPOCH) // timedelta(microseconds=1)
    days = [r[0] for r in stats.where(F.col("max_us") < start).select("source_day").collect()]  # one a day
    day = F.col(S.DAY_PARTITION)
    return day.isNull() | ~day.isin(days)


# --- U3..U5: slice, chunk, advance ---------------------------------------------


def after_cursor(df: DataFrame, cursor: Cursor, lookback: timedelta | None = None) -> DataFrame:
    """Rows after the cursor (strict unless inclusive); rows
    without a timestamp never pass. ``lookback`` reaches back for late rows,
    which the keyed upsert absorbs."""
    start = cursor.ts - lookback if lookback else cursor.ts
    ts = F.col("timestamp")
    cond = ts >= F.lit(start) if (cursor.inclusive or lookback) else ts > F.lit(start)
    return df.where(ts.isNotNull() & cond)


_BOUNDARY = """
WITH days AS (SELECT b, n, sum(n) OVER (ORDER BY b) AS upto
              FROM (SELECT floor(us / 86400000000) AS b, sum(n) AS n FROM {counts} GROUP BY 1)),
day AS (SELECT min_by(b, b) AS b, min_by(upto - n, b) AS before FROM days WHERE upto >= :size),
minutes AS (SELECT b, n, (SELECT before FROM day) + sum(n) OVER (ORDER BY b) AS upto
            FROM (SELECT floor(us / 60000000) AS b, sum(n) AS n FROM {counts}
                  WHERE floor(us / 86400000000) = (SELECT b FROM day) GROUP BY 1)),
minute AS (SELECT min_by(b, b) AS b, min_by(upto - n, b) AS before FROM minutes WHERE upto >= :size),
moments AS (SELECT us, (SELECT before FROM minute) + sum(n) OVER (ORDER BY us) AS upto
            FROM {counts} WHERE floor(us / 60000000) = (SELECT b FROM minute))
SELECT min(us) AS us FROM moments WHERE upto >= :size
"""


def first_chunk(df: DataFrame, cursor: Cursor, size: int) -> DataFrame:
    """A1 with a cap: the first ``size`` rows after the cursor by timestamp,
    extended to the end of the last timestamp so that no row sharing the
    boundary timestamp is skipped by the next chunk.

    Rows are counted by moment once, and the counts (two numbers a moment) are
    staged. The boundary is found on them by day, inside the boundary day by
    minute, inside the boundary minute by moment: a running sum sees one row a
    day, 1,440 minutes, or the moments of one minute. The rows are then read
    with the boundary as a literal, which scans can push down.
    """
    rows = after_cursor(df, cursor)
    counts = TB.kept(rows.groupBy(F.unix_micros("timestamp").alias("us")).agg(F.count(F.lit(1)).alias("n")), "moments")
    end = df.sparkSession.sql(_BOUNDARY, args={"size": size}, counts=counts).first()["us"]
    return rows if end is None else rows.where(F.col("timestamp") <= F.timestamp_micros(F.lit(end)))


def advance(loaded: DataFrame) -> DataFrame:
    """U4/A3/A4: rows loaded and the new cursor (their max timestamp), one row."""
    return loaded.agg(F.count("*").alias("rows_loaded"), F.max("timestamp").alias("new_cursor"))


# --- U1: keyed upsert ------------------------------------------------------------


def upsert(old: DataFrame, new: DataFrame, key: list[str] = S.SERVING_KEY) -> DataFrame:
    """The table after upserting ``new`` into ``old`` by ``key``.

    A key present in ``new`` takes its row from ``new`` (all other columns
    overwritten); among several new rows of one key the newest by
    ingested_at, source_day, source_file, page_name, funnel_id, session_id
    (descending, nulls last, then a hash of the row) wins. Keys only in
    ``old`` keep their row. One shuffle on the key; WindowGroupLimit keeps
    at most one row per key and input task before it.
    """
    cols = [c for c in old.columns]
    both = old.select(*cols, F.lit(0).alias(PRIORITY)).unionByName(new.select(*cols, F.lit(1).alias(PRIORITY)))
    order = [F.col(PRIORITY).desc()] + [F.col(c).desc_nulls_last() for c in S.SERVING_ORDER]
    order.append(F.xxhash64(*[F.col(c) for c in cols]).desc())
    w = Window.partitionBy(*[F.col(c) for c in key]).orderBy(*order)
    return both.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) == 1).drop(RANK, PRIORITY)


STATUS = "status"
INSERTED, CHANGED, UNCHANGED = "inserted", "changed", "unchanged"


def changes(old: DataFrame, new: DataFrame, key: list[str] = S.SERVING_KEY) -> DataFrame:
    """U1 as the server counts it: the row of every key in ``new`` (of several the
    newest, as in ``upsert``) and what an upsert does to the key: inserted,
    changed, or unchanged when all its columns are as they were.

    The old side of the join is a key and a hash of the row; old rows travel no
    further. Keys only in ``old`` are not touched and not returned."""
    fresh = upsert(new.limit(0), new, key)
    rest = [c for c in fresh.columns if c not in key]
    # a NULL is hashed as a place of its own, so that it differs from the value next to it
    mark = lambda: F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in rest])
    was = old.select(*[F.col(c).alias(f"_old_{c}") for c in key], mark().alias("_was"), F.lit(True).alias("_there"))
    same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in key]
    status = F.when(F.col("_there").isNull(), INSERTED).when(F.col("_was") == mark(), UNCHANGED).otherwise(CHANGED)
    return fresh.join(was, on=same, how="left").select(*fresh.columns, status.alias(STATUS))


def _swap_in(rows: DataFrame, path: str, partition: str) -> None:
    (
        rows.hint("rebalance", partition)
        .sortWithinPartitions(partition, *S.SERVING_KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_upsert(updates: DataFrame, path: str, partition: str = "event_date") -> dict:
    """U1 on storage: upsert serving rows into the table at ``path``. Returns rows
    given, their max timestamp, keys inserted, changed and unchanged, and the
    dates rewritten.

    The updates are staged once; their row count, max timestamp and distinct
    dates (one value per calendar day) are observed during that write. Old rows
    of these dates, by partition pruning, tell what an update does (``changes``);
    what does something is staged, and only the dates of such rows are written
    again. Updates that change nothing write nothing.

    The merge is first written in full beside the table (``tables.redo``) and
    then swapped in by dynamic partition overwrite. Spark's commit removes
    the old date folders before it puts the new ones in place; a driver lost
    in between leaves the complete merge, which the next call applies before
    anything else, so no served row is lost. A first load has no old rows
    and is written directly.
    """
    spark = updates.sparkSession
    TB.redo(spark, path, lambda rows: _swap_in(rows, path, partition))
    seen = Observation("upsert")
    observed = updates.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.max("timestamp").alias("max_timestamp"),
        F.collect_set(partition).alias("dates"),
    )
    fs, root = TB._fs(spark, path)
    if not fs.exists(root):
        wrote = Observation("first")
        _swap_in(upsert(observed.limit(0), observed).observe(wrote, F.count(F.lit(1)).alias("rows")), path, partition)
        metrics = seen.get
        return {
            "rows": metrics["rows"], "max_timestamp": metrics["max_timestamp"], "dates": sorted(metrics["dates"]),
            INSERTED: wrote.get["rows"], CHANGED: 0, UNCHANGED: 0,
        }
    counts, dates = {INSERTED: 0, CHANGED: 0, UNCHANGED: 0}, []
    with TB.staged(observed, "upsert-new") as fresh:
        metrics = seen.get
        if metrics["rows"]:
            old = spark.read.parquet(path).select(*fresh.columns)
            told = changes(old.where(F.col(partition).isin(sorted(metrics["dates"]))), fresh)
            done = Observation("changes")
            is_ = lambda name: F.coalesce(F.sum((F.col(STATUS) == name).cast("long")), F.lit(0)).alias(name)
            counted = told.observe(done, *[is_(c) for c in counts])
            with TB.staged(counted.where(F.col(STATUS) != UNCHANGED), "upsert-changes") as doing:
                counts = {c: done.get[c] for c in counts}
                dates = sorted(r[0] for r in doing.select(partition).distinct().collect())  # one a day
                if dates:
                    TB.write_pending(upsert(old.where(F.col(partition).isin(dates)), doing.drop(STATUS)), path)
                    TB.redo(spark, path, lambda rows: _swap_in(rows, path, partition))
    return {"rows": metrics["rows"], "max_timestamp": metrics["max_timestamp"], "dates": dates, **counts}


# --- S17 / U1 against a relational serving table over JDBC ------------------------


def mysql_table_ddl(table: str) -> str:
    """CREATE TABLE text of the serving table (MySQL dialect), keys included."""
    sql_types = {
        "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
        "timestamp_ntz": "DATETIME(6)", "decimal(18,6)": "DECIMAL(18,6)",
    }
    lines = []
    for f in S.SERVING_SCHEMA.fields:
        t = f.dataType.simpleString()
        if f.name in S.SERVING_VARCHAR:
            t = f"VARCHAR({S.SERVING_VARCHAR[f.name]})"
        elif f.name in S.SERVING_TEXT_BYTES:
            t = "TEXT"
        else:
            t = sql_types[t]
        lines.append(f"  `{f.name}` {t} {'NULL' if f.nullable else 'NOT NULL'}")
    keys = ", ".join(f"`{c}`" for c in S.SERVING_KEY)
    lines.append(f"  PRIMARY KEY ({keys})")
    lines.append("  KEY by_event_time (`timestamp`)")
    lines.append("  KEY by_file_day (`source_day`)")
    # four-byte characters (emoji, some scripts) need this character set
    return f"CREATE TABLE IF NOT EXISTS `{table}` (\n" + ",\n".join(lines) + "\n) ENGINE=InnoDB DEFAULT CHARACTER SET utf8mb4"


def mysql_merge_sql(table: str, staging: str) -> str:
    """One server-side upsert from a staging table into the serving table: the
    staged row, named by an alias, wins on a key that is there already."""
    names = [f"`{f.name}`" for f in S.SERVING_SCHEMA.fields]
    changes = [f"{n} = fresh.{n}" for n in names if n.strip("`") not in S.SERVING_KEY]
    return (
        f"INSERT INTO `{table}` ({', '.join(names)})\n"
        f"SELECT * FROM (SELECT {', '.join(names)} FROM `{staging}`) AS fresh\n"
        f"ON DUPLICATE KEY UPDATE {', '.join(changes)}"
    )


def jdbc_upsert(
    rows: DataFrame, url: str, table: str, properties: dict, batchsize: int = 10_000, connections: int = 16
) -> None:
    """Write serving rows to a staging table of this load in parallel (at most
    ``connections``, batched inserts), then run one merge statement on the
    server and drop the staging table.

    Rows must already be unique per key (``upsert(rows.limit(0), rows)``).
    Untested here: no database server may run in this environment.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    widths = ", ".join(
        f"{c} VARCHAR({n})" for c, n in S.SERVING_VARCHAR.items()
    )
    (
        rows.write.mode("overwrite")
        .option("createTableColumnTypes", widths)
        .option("batchsize", batchsize)
        .option("numPartitions", connections)
        .jdbc(url, staging, properties=properties)
    )
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        stmt.execute(mysql_table_ddl(table))
        stmt.execute(mysql_merge_sql(table, staging))
        conn.commit()
        stmt.execute(f"DROP TABLE `{staging}`")
    finally:
        conn.close()
