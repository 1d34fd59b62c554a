"""Day files: split, land, list, select and scan.

A *day file* is an entry named ``YYYYMMDD_<SUFFIX>.parquet`` in a landing
folder. It may be a single Parquet file (as written by other tools) or a
partition directory ``day_file=YYYYMMDD_<SUFFIX>.parquet`` of part files, as
written here: one day is written by many tasks in parallel, and Spark's
dynamic partition overwrite replaces exactly the days written. Both read
the same way: the day is taken from the path with an unanchored pattern,
which matches the entry whichever form it has.

Selection rules are Column predicates over a ``path`` column. They apply to
a file listing (a small DataFrame of paths) and equally to the scanned
rows' ``_metadata.file_path``; on a scan, Catalyst uses them to skip whole
files, so a range read opens only the files of the range.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake import schema as S
from eventlake.functions import cleaning as C
from eventlake.functions import ranges as R

# Fixed value: default name pattern of a day file, anchored; group 1 is the
# day, group 2 the suffix.
NAME_PATTERN = r"^(\d{8})_([A-Za-z0-9]+)\.parquet$"
DAY_TEXT = re.compile(r"\d{8}")
PATH = "path"
NAME = "name"
DAY_FILE = "day_file"  # partition column of day entries written here


# --- path expressions ----------------------------------------------------------


def base_name(path: str | Column) -> Column:
    """Last component of a path."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]+)/?$", 1)


def entry_name(path: str | Column, suffix: str = S.DEFAULT_SUFFIX) -> Column:
    """Name of the day entry a path belongs to: the day directory for a part
    file inside one (without a ``key=`` partition prefix), else the file's
    own name."""
    p = F.col(path) if isinstance(path, str) else path
    # it runs for every row of a scan, so the path is cut at its marks: a pattern
    # that may begin anywhere takes the square of a component's length
    after = lambda c, mark: F.substring_index(c, mark, -1)
    folder = after(F.substring_index(F.substring_index(p, "/", -2), "/", 1), "=")
    inside = p.contains("/") & ~p.endswith("/") & folder.endswith(".parquet") & (F.length(folder) > len(".parquet"))
    own = after(F.when(p.endswith("/"), p.substr(F.lit(1), F.length(p) - 1)).otherwise(p), "/")
    key = F.instr(own, "=")
    return F.when(inside, folder).when(key > 1, own.substr(key + 1, F.length(own))).otherwise(own)


def in_file_range(path: str | Column, start: date | str, end: date | str, suffix: str = S.DEFAULT_SUFFIX) -> Column:
    """Path's day (from its name) BETWEEN start AND end; no day -> false."""
    day = C.day_of_file(path, suffix)
    return F.coalesce(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))


def has_suffix(path: str | Column, suffix: str = S.DEFAULT_SUFFIX) -> Column:
    """Glob ``*_<suffix>.parquet`` on the entry name."""
    return entry_name(path, suffix).endswith(f"_{suffix}.parquet")


# --- reading -------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_bulk(spark: SparkSession, path: str, timestamp_col: str = "timestamp") -> DataFrame:
    """The bulk Parquet file; errors if it or its timestamp column is missing."""
    if not exists(spark, path):
        raise FileNotFoundError(f"there is no bulk file at {path}")
    df = spark.read.parquet(path)
    if timestamp_col not in df.columns:
        raise ValueError(f"{path} has no event time column {timestamp_col!r}")
    return df


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_entries(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Rows of the given day entries plus ``source_file``, one DataFrame per
    schema: usually one. The columns are loose, so a day may hold text where
    another holds numbers; such entries are grouped by their own schema (read
    from the entry's footer), and each group can be typed by its rules."""
    try:
        return [_with_file(spark.read.option("mergeSchema", "true").parquet(*paths))]
    except Exception as e:  # the entries' schemas do not merge
        if "CANNOT_MERGE_SCHEMAS" not in str(e) and "CANNOT_MERGE_INCOMPATIBLE" not in str(e):
            raise
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return [_with_file(spark.read.parquet(*group)) for _, group in sorted(groups.items())]


def day_entries(spark: SparkSession, folder: str, suffix: str = S.DEFAULT_SUFFIX) -> list[str]:
    """Paths of all entries named ``*_<suffix>.parquet``, by a glob."""
    fs, pattern = _fs(spark, f"{folder.rstrip('/')}/*_{suffix}.parquet")
    return sorted(st.getPath().toString() for st in fs.globStatus(pattern) or [])


def range_entries(spark: SparkSession, folder: str, days: list[date], suffix: str = S.DEFAULT_SUFFIX) -> list[tuple[str, str]]:
    """(name, path) of the days' entries that exist: one test a day and
    form, so neither other days nor odd names in the folder matter."""
    found = []
    for day in days:
        name = f"{day:%Y%m%d}_{suffix}.parquet"
        for entry in (name, f"{DAY_FILE}={name}"):
            fs, p = _fs(spark, f"{folder.rstrip('/')}/{entry}")
            if fs.exists(p):
                found.append((name, p.toString()))
                break
    return found


def _one(frames: list[DataFrame]) -> DataFrame:
    """One DataFrame of groups of differing types: their columns as text."""
    if len(frames) == 1:
        return frames[0]
    out = None
    for f in frames:
        f = f.select(*[F.col(c).cast("string").alias(c) for c in f.columns])
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def read_day_files(spark: SparkSession, folder: str, suffix: str = S.DEFAULT_SUFFIX) -> DataFrame:
    """Every day file with the suffix, plus ``source_file`` (full path).

    A folder without one is an error, as a wildcard over no files is.
    """
    paths = day_entries(spark, folder, suffix)
    if not paths:
        raise FileNotFoundError(f"{folder} holds no day file with suffix {suffix}")
    return _one(read_entries(spark, paths))


def read_range(
    spark: SparkSession, folder: str, start: date | str, end: date | str, suffix: str = S.DEFAULT_SUFFIX,
    view: str | None = None,
) -> DataFrame:
    """Rows of the day files of [start, end] that exist; missing days are
    simply absent, no day at all is an error. ``view`` also names the rows as
    a temporary view, created or replaced."""
    first, last = R.parse_day(start), R.parse_day(end)
    entries = range_entries(spark, folder, R.days_between(first, last), suffix)
    if not entries:
        raise FileNotFoundError(f"{folder} holds no day file from {first} to {last}")
    df = _one(read_entries(spark, [p for _, p in entries]))
    if view:
        df.createOrReplaceTempView(view)
    return df


# --- the landing folder as a catalog table -------------------------------------


def landing_table(spark: SparkSession, name: str, folder: str, schema: T.StructType) -> None:
    """Name the landing folder's entries (those written here, as partition folders)
    as a catalog table partitioned by entry, created if absent; entries landed or
    removed since are taken up (partition metadata only)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != DAY_FILE)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {DAY_FILE} STRING) USING parquet PARTITIONED BY ({DAY_FILE}) LOCATION '{folder}'")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def range_of_table(spark: SparkSession, name: str, start: date | str, end: date | str, suffix: str = S.DEFAULT_SUFFIX) -> DataFrame:
    """S4/W1 on the catalog table: its rows of the days from ``start`` to ``end``, by a
    join with the list of days. The join prunes: Spark sends the days' entries to
    the scan (dynamic partition pruning), which reads only these partitions. Days
    without an entry are absent. Adds ``source_day``."""
    first, last = R.parse_day(start), R.parse_day(end)
    days = R.range_days(spark, first, last).where(F.col("day").between(F.lit(first), F.lit(last)))
    wanted = days.select(R.day_file_name(F.col("day_key"), suffix).alias(DAY_FILE), F.col("day").alias("source_day"))
    # wanted: a row for each day of the range, a number known here
    return spark.table(name).join(F.broadcast(wanted), DAY_FILE)


# --- listing and selection -----------------------------------------------------


def list_entries(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """``*.parquet`` entries of a folder, sorted, as a (path, name) DataFrame.

    The listing is file-system metadata (one entry per day file) taken on
    the driver, as Spark's own file index does. Errors when the folder is
    missing or holds no Parquet entry.
    """
    fs, root = _fs(spark, folder)
    if not fs.exists(root):
        raise FileNotFoundError(f"cannot list {folder}: it does not exist")
    found: list[tuple[str, str]] = []
    pending = [root]
    while pending:
        current = pending.pop()
        for st in fs.listStatus(current):
            name = st.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if name.endswith(".parquet"):
                found.append((st.getPath().toString(), name.split("=", 1)[-1]))
            elif st.isDirectory() and recursive:
                pending.append(st.getPath())
    if not found:
        raise FileNotFoundError(f"{folder} holds no .parquet entry" + (" at any depth" if recursive else ""))
    found.sort()
    return spark.createDataFrame(found, f"{PATH} string, {NAME} string")


def listing_of(rows: DataFrame, path_col: str = "source_file") -> DataFrame:
    """Distinct (path, name) of the day entries rows come from."""
    p = F.col(path_col)
    return rows.select(p.alias(PATH)).distinct().select(PATH, entry_name(PATH).alias(NAME))


def select_by_name(listing: DataFrame, names: list[str]) -> DataFrame:
    """Entries whose name is one of ``names``."""
    return listing.where(F.col(NAME).isin(list(names)))


def missing_names(selected: DataFrame, names: list[str]) -> list[str]:
    """A5: wanted names absent from a selection (at most len(names) values)."""
    spark = selected.sparkSession
    wanted = spark.createDataFrame([(n,) for n in sorted(set(names))], f"{NAME} string")
    gone = wanted.join(selected.select(NAME), on=NAME, how="left_anti")
    return sorted(r[0] for r in gone.collect())


def validate_day_bound(value: str | None, field: str) -> None:
    if value is not None and not DAY_TEXT.fullmatch(value):
        raise ValueError(f"{field}: eight digits of a day are expected, not {value!r}")


def _name_pattern(pattern: str) -> tuple[str, int, int]:
    """(Java pattern anchored at the start, day group, suffix group)."""
    python_form = re.sub(r"\(\?<(?=[A-Za-z])", "(?P<", pattern)
    groups = re.compile(python_form).groupindex
    java = re.sub(r"\(\?P<", "(?<", pattern)
    return f"^(?:{java})", groups.get("date", 1), groups.get("suffix", 2)


def select_by_filters(
    listing: DataFrame,
    date_start: str | None = None,
    date_end: str | None = None,
    suffix: str | None = None,
    pattern: str = NAME_PATTERN,
) -> DataFrame:
    """Entries whose name matches the pattern at its start, with optional
    suffix and inclusive day bounds (compared as YYYYMMDD text).

    The pattern may name its groups ``date`` and ``suffix``, in Python
    (``(?P<date>...)``) or Java (``(?<date>...)``) syntax; unnamed, group 1
    is the day and group 2 the suffix.
    """
    validate_day_bound(date_start, "date_start")
    validate_day_bound(date_end, "date_end")
    java, day_group, suffix_group = _name_pattern(pattern)
    name = F.col(NAME)
    day = F.regexp_extract(name, java, day_group)
    suf = F.regexp_extract(name, java, suffix_group)
    cond = name.rlike(java)
    if suffix:
        cond = cond & (suf == suffix)
    if date_start:
        cond = cond & (day >= date_start)
    if date_end:
        cond = cond & (day <= date_end)
    return listing.where(cond).select(PATH, NAME, day.alias("file_date"), suf.alias("file_suffix"))


def pick_files(
    listing: DataFrame,
    names: list[str] | None = None,
    date_start: str | None = None,
    date_end: str | None = None,
    suffix: str | None = None,
    pattern: str = NAME_PATTERN,
) -> DataFrame:
    """Exact names first, else filters, else everything; errors as the
    original selection does (missing names; nothing matched)."""
    if names:
        selected = select_by_name(listing, names)
        gone = missing_names(selected, names)
        if gone:
            raise FileNotFoundError(f"wanted by name but absent: {', '.join(gone)}")
        return selected
    if date_start or date_end or suffix:
        selected = select_by_filters(listing, date_start, date_end, suffix, pattern).select(PATH, NAME)
        if selected.isEmpty():
            wanted = {"from": date_start, "to": date_end, "suffix": suffix}
            raise FileNotFoundError(f"nothing to pick with {({k: v for k, v in wanted.items() if v})}")
        return selected
    return listing


def landing_plan(candidates: DataFrame, landed: DataFrame, skip_if_exists: bool = True) -> DataFrame:
    """Per candidate entry, whether it is landed now or skipped.

    ``landed`` is the listing of the target folder. Matching is by entry
    name; of several candidates with one name the first by path is landed
    and the others are skipped. Output: name, source path, action
    ('uploaded' | 'skipped').
    """
    there = landed.select(F.col(NAME).alias("_landed")).distinct()
    ranked = candidates.withColumn("_turn", F.row_number().over(Window.partitionBy(NAME).orderBy(PATH)))
    joined = ranked.join(there, ranked[NAME] == there["_landed"], "left")
    skip = (F.col("_landed").isNotNull() | (F.col("_turn") > 1)) if skip_if_exists else F.lit(False)
    action = F.when(skip, F.lit("skipped")).otherwise(F.lit("uploaded"))
    return joined.select(F.col(NAME), F.col(PATH), action.alias("action"))


# --- splitting and writing -----------------------------------------------------


def split_plan(
    df: DataFrame, timestamp_col: str = "timestamp", suffix: str = S.DEFAULT_SUFFIX
) -> DataFrame:
    """Rows with their UTC day key and target day-file name.

    Integer timestamps are epoch nanoseconds, text is parsed (an error on
    text that is not a time), timestamps are used as they are. Rows without
    a timestamp belong to no day and are dropped.
    """
    if timestamp_col not in df.columns:
        raise ValueError(f"the rows have no event time column {timestamp_col!r}")
    kind = df.schema[timestamp_col].dataType
    key = F.expr(f"date_format({C.utc_date_sql(C.micros_sql(timestamp_col, kind))}, 'yyyyMMdd')")
    return (
        df.where(F.col(timestamp_col).isNotNull())
        .withColumn("day_key", key)
        .withColumn("file_name", F.concat(F.col("day_key"), F.lit(f"_{suffix}.parquet")))
    )


def split_summary(plan: DataFrame, sample: int = 10) -> DataFrame:
    """S3: number of day files, first names (sorted) and rows, one row.

    Rows are counted per day first (map-side partial counts), so the final
    one-row aggregate sees one row per day, never the raw rows.
    """
    per_day = plan.groupBy("file_name").agg(F.count("*").alias("n"))
    return per_day.agg(
        F.count("*").alias("num_files"),
        F.slice(F.sort_array(F.collect_list("file_name")), 1, sample).alias("files_sample"),
        F.sum("n").alias("num_rows"),
    )


def write_day_files(plan: DataFrame, folder: str, suffix: str = S.DEFAULT_SUFFIX) -> list[str]:
    """Write each day of a split plan as one day entry, replacing that day.

    Days not in the plan stay as they are (dynamic partition overwrite on
    ``day_file``; the commit swaps in exactly the days written). Rows are
    spread with ``REBALANCE(day_file)``: AQE splits a hot day over several
    tasks, so a day holding a third of all rows is still written in
    parallel. The names written are observed during the write (one value
    per day). Returns them sorted.
    """
    return write_entries(plan.withColumn(DAY_FILE, F.concat(F.col("day_key"), F.lit(f"_{suffix}.parquet"))), folder)


def write_entries(rows: DataFrame, folder: str) -> list[str]:
    """Write rows as the entries their column ``day_file`` names, replacing
    those entries; returns the names written, sorted."""
    keep = [c for c in rows.columns if c not in ("day_key", "file_name", DAY_FILE)]
    seen = Observation("day_files")
    (
        rows.observe(seen, F.collect_set(DAY_FILE).alias("names"))
        .hint("rebalance", DAY_FILE)
        .select(*keep, DAY_FILE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_FILE)
        .parquet(folder)
    )
    return sorted(seen.get["names"])
