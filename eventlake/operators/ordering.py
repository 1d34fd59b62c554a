"""Order over a whole table without a task that sees all of it.

``running_counts`` numbers rows in a global order: range partitions, a count a
partition, and a running sum inside each. ``curve`` builds on it: the four
clustering columns get buckets of equal row counts, and the bits of the buckets
are interleaved, so that rows near in any of the four lie near in the
table. A lexicographic sort prunes row groups by its first column alone; along
the curve a filter on any one of them skips most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators import tables as TB

CURVE_COLUMNS = ["country", "page_name", "hotel_id", "funnel_id"]
#: Bits of each column's bucket: 16 buckets.
CURVE_BITS = 4


def running_counts(rows: DataFrame, order: list[str], weight: str) -> DataFrame:
    """``rows`` with ``before`` and ``upto``: the sum of ``weight`` over all rows
    before it, and through it, in the global order of ``order`` (distinct).

    The range partitions are staged, since their limits come from a sample and
    both the sums and the rows must see the same ones. The running sum over
    partitions has one row a partition.
    """
    ranged = rows.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id())
    ranged = TB.kept(ranged, "ranged")
    sums = ranged.groupBy("_part").agg(F.sum(weight).alias("_n"))
    base = sums.withColumn("_base", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).select("_part", "_base")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("_base") + F.sum(weight).over(inside)
    # base: one row for each shuffle partition
    counted = ranged.join(F.broadcast(base), "_part").withColumn("upto", upto)
    return counted.withColumn("before", F.col("upto") - F.col(weight)).drop("_part", "_base")


@dataclass(frozen=True)
class Curve:
    """The lowest value of each bucket, by column: at most ``2 ** bits`` each."""

    limits: dict[str, list]
    bits: int

    def bucket(self, column: str) -> Column:
        """Bucket of a column's value; a NULL is in the first, as are values below
        all that the limits were taken from."""
        out = F.lit(0)
        for number, low in self.limits[column]:
            out = F.when(F.col(column) >= F.lit(low), number).otherwise(out)
        return out

    def place(self) -> Column:
        """Place on the curve: the buckets' bits in turn, highest first."""
        columns, out = list(self.limits), F.lit(0)
        for i, column in enumerate(columns):
            bucket = self.bucket(column)
            for b in range(self.bits):
                bit = F.shiftleft(F.shiftright(bucket, b).bitwiseAND(1), b * len(columns) + len(columns) - 1 - i)
                out = out.bitwiseOR(bit)
        return out


def curve(df: DataFrame, columns: list[str] = CURVE_COLUMNS, bits: int = CURVE_BITS) -> Curve:
    """The curve of a table: limits of buckets that hold equal numbers of its rows.

    One pass: the columns are stacked, each value is counted (a hot one once a
    task) and the counts are summed in value order by ``running_counts``. The
    driver sees the limits, at most ``len(columns) * 2 ** bits`` values.
    """
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    parts = []
    for i, c in enumerate(columns):
        number = F.lit(None).cast("long") if c in text else F.col(c).cast("long")
        word = F.col(c) if c in text else F.lit(None).cast("string")
        parts.append(F.struct(F.lit(i).alias("c"), number.alias("number"), word.alias("word")))
    stacked = df.select(F.explode(F.array(*parts)).alias("v")).select("v.*").where("number IS NOT NULL OR word IS NOT NULL")
    values = stacked.groupBy("c", "number", "word").agg(F.count(F.lit(1)).alias("n"))
    counted = TB.kept(running_counts(values, ["c", "number", "word"], "n"), "curve")
    totals = counted.groupBy("c").agg(F.min("before").alias("first"), F.sum("n").alias("rows"))
    # totals: one row a column
    placed = counted.join(F.broadcast(totals), "c").withColumn("bucket", F.expr(f"(before - first) * {1 << bits} div rows"))
    lows = placed.groupBy("c", "bucket").agg(F.min(F.struct("number", "word")).alias("low")).orderBy("c", "bucket").collect()
    limits = {c: [(r["bucket"], r["low"]["word" if c in text else "number"]) for r in lows if r["c"] == i] for i, c in enumerate(columns)}
    return Curve(limits, bits)


def along(df: DataFrame, on: Curve) -> DataFrame:
    """The rows with their place on the curve."""
    return df.withColumn("curve_place", on.place())


def write_along(df: DataFrame, path: str, on: Curve | None = None) -> None:
    """The table written by day, each day's rows along the curve. Row-group
    statistics then prune on every clustering column. Hot days are split by
    AQE into ranges of rows, each sorted by itself."""
    placed = along(TB.in_table_order(df), on or curve(df))
    (
        placed.hint("rebalance", S.DAY_PARTITION)
        .sortWithinPartitions(S.DAY_PARTITION, "curve_place", *CURVE_COLUMNS)
        .drop("curve_place")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(S.DAY_PARTITION)
        .parquet(path)
    )
