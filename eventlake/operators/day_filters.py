"""Which days may hold a request: a Bloom filter for each day of a table.

An event key touched by a recent run may have copies on any day. Without help,
the table is scanned in the keys' time span for them. A filter per day, kept
beside the table, answers without opening the day's files; it may say yes for a
day that has none, never no for a day that has one.

A filter is a table of words: (source_day, size, word, mask). Its size in bits
follows the rows of the day. It is built by Spark's own aggregates: positions
are exploded, and masks are or-ed per task before the shuffle. Probing joins the
touched requests' positions with the words. Days of the table without a filter
count as "may hold"; a day's filter is removed before the day is replaced and
built after, so a lost run makes probing slower, not wrong.
"""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators import tables as TB

#: Positions set by a request, and bits of the filter for each row of a day: a
#: request that a day does not hold passes with a probability of about 6e-6.
HASHES, BITS_A_ROW = 8, 32
KEY = "request_id"
FILTER_SCHEMA = "size bigint, word bigint, mask bigint, source_day date"


def _halves(key: str) -> list[Column]:
    """Two numbers of 60 bits from a digest of the key; NULL is a key of its own."""
    digest = F.md5(F.when(F.col(key).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(key))).cast("binary"))
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]


def _positions(size: Column) -> Column:
    """The positions of a key in a filter of ``size`` bits, by double hashing."""
    return F.array(*[F.pmod(F.pmod(F.col("_h1"), size) + i * F.pmod(F.col("_h2"), size), size) for i in range(HASHES)])


def _hashed(rows: DataFrame, *keep: str) -> DataFrame:
    first, second = _halves(KEY)
    return rows.select(*keep, first.alias("_h1"), second.alias("_h2")).distinct()


def filters_of(rows: DataFrame) -> DataFrame:
    """(size, word, mask, source_day) of the rows' days; rows without a day have none."""
    day = S.DAY_PARTITION
    dated = rows.where(F.col(day).isNotNull())
    sizes = dated.groupBy(F.col(day).alias("_day")).agg(F.expr(f"CAST(pow(2, ceil(log2(count(*) * {BITS_A_ROW}))) AS BIGINT)").alias("size"))
    # sizes: one row a day
    keys = _hashed(dated, day).join(F.broadcast(sizes), F.col(day) == F.col("_day"))
    bits = keys.select(day, "size", F.explode(_positions(F.col("size"))).alias("at"))
    word = bits.groupBy(day, "size", F.shiftright("at", 6).alias("word"))
    return word.agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("mask")).select("size", "word", "mask", day)


def maybe_days(filters: DataFrame, keys: DataFrame) -> list[date]:
    """Days whose filter lets one of the keys pass (driver: one value a day)."""
    sizes = [r[0] for r in filters.select("size").distinct().collect()]  # powers of two: a few dozen at most
    if not sizes:
        return []
    probes = _hashed(keys).withColumn("size", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    at = probes.select("size", "_h1", "_h2", F.explode(_positions(F.col("size"))).alias("at")).distinct()
    need = at.groupBy("size", "_h1", "_h2").agg(F.count(F.lit(1)).alias("need"))
    asked = at.withColumn("word", F.shiftright("at", 6)).withColumn("bit", F.expr("shiftleft(1L, CAST(at & 63 AS INT))"))
    hits = asked.join(filters, ["size", "word"]).where(F.col("mask").bitwiseAND(F.col("bit")) != 0)
    each = hits.groupBy(S.DAY_PARTITION, "size", "_h1", "_h2").agg(F.count(F.lit(1)).alias("got"))
    passed = each.join(need, ["size", "_h1", "_h2"]).where("got = need").select(S.DAY_PARTITION).distinct()
    return sorted(r[0] for r in passed.collect())


# --- on storage -------------------------------------------------------------------


def place(table: str) -> str:
    """Where the filters of the table at a path are kept."""
    return f"{table.rstrip('/')}__filters"


def _named_days(spark: SparkSession, path: str) -> set[date]:
    fs, root = TB._fs(spark, path)
    names = [unquote(st.getPath().getName()) for st in fs.listStatus(root)] if fs.exists(root) else []
    days = [n.split("=", 1)[1] for n in names if n.startswith(f"{S.DAY_PARTITION}=")]
    return {date.fromisoformat(d) for d in days if not d.startswith("__")}


def forget(spark: SparkSession, table: str, days: list[date] | None = None) -> None:
    """Remove the filters of days that are about to change (all without ``days``)."""
    fs, root = TB._fs(spark, place(table))
    if days is not None:
        TB.drop_days(spark, place(table), days)
    elif fs.exists(root):
        fs.delete(root, True)


def build(spark: SparkSession, table: str, days: list[date] | None = None) -> None:
    """Build the filters of days of the table at ``table`` (all without ``days``),
    and of those that have none."""
    rows = TB.read_table(spark, table)
    if days is not None:
        missing = _named_days(spark, table) - _named_days(spark, place(table))
        rows = rows.where(F.col(S.DAY_PARTITION).isin(sorted({*days, *missing})))
    (
        filters_of(rows)
        .hint("rebalance", S.DAY_PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(S.DAY_PARTITION)
        .parquet(place(table))
    )


def may_hold(spark: SparkSession, table: str, keys: DataFrame) -> Column:
    """Partition filter of the table at ``table``: days that may hold one of the
    keys (column ``request_id``), days without a filter, rows without a day."""
    known = _named_days(spark, place(table))
    day = F.col(S.DAY_PARTITION)
    if not known:
        return F.lit(True)
    filters = spark.read.schema(FILTER_SCHEMA).parquet(place(table))
    no = sorted(known - set(maybe_days(filters, keys)))
    return day.isNull() | ~day.isin(no)
