"""D1 kept up to date: the newest copy of every event as a streaming aggregate.

The typed table's new files are the stream; the state holds, for each event key,
the newest copy seen (``max`` over the delivery order, ended by the hash that
ends it in ``dedupe.newest_first``), in RocksDB. Update mode hands on the keys
whose winner a batch may have changed, and these rows replace the keys' old rows
in the live table. Deliveries may be late or out of order: a copy older than the
winner changes nothing. There is no watermark, since a copy may come at any
time; the state is as large as the deduplicated table.

The live table is partitioned by ``event_date``. The key holds the time of the
event, so a key never moves, and a batch rewrites only the dates it touches. A
batch that runs again replaces the same keys by the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake import session as SESSION
from eventlake.operators import dedupe as D
from eventlake.operators import tables as TB

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITION = "event_date"


def latest(typed: DataFrame) -> DataFrame:
    """One row per event key, in table order; the same winners as ``dedupe_full``,
    on a batch or a stream."""
    rest = [c for c in typed.columns if c not in S.DEDUPE_KEY and c not in S.DEDUPE_ORDER]
    # NULLs are lowest in a struct, as in "descending, nulls last"
    best = F.max(F.struct(*S.DEDUPE_ORDER, F.xxhash64(*[F.col(c) for c in rest]).alias("_tie"), *rest)).alias("_best")
    won = typed.groupBy(*S.DEDUPE_KEY).agg(best)
    return won.select(*[c if c in S.DEDUPE_KEY else F.col(f"_best.{c}").alias(c) for c in S.TYPED_COLUMNS])


def _swap_in(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The live table, columns in table order."""
    return TB.in_table_order(spark.read.schema(S.TYPED_SCHEMA).parquet(path))


def put_winners(winners: DataFrame, path: str) -> None:
    """Replace the rows of the winners' keys; dates that they do not touch stay. An
    interrupted replacement is finished by the next call (``tables.redo``)."""
    spark = winners.sparkSession
    TB.redo(spark, path, lambda rows: _swap_in(rows, path))
    seen = Observation("winners")
    observed = winners.observe(seen, F.collect_set(PARTITION).alias("dates"), F.max(F.col(PARTITION).isNull()).alias("undated"))
    fs, root = TB._fs(spark, path)
    if not fs.exists(root):
        _swap_in(observed, path)
        return
    with TB.staged(observed, "winners") as fresh:
        dates, day = sorted(seen.get["dates"]), F.col(PARTITION)
        touched = day.isin(dates) | (day.isNull() & F.lit(bool(seen.get["undated"])))
        keys = fresh.select(*[F.col(c).alias(f"{D.KEY_PREFIX}{c}") for c in S.DEDUPE_KEY])
        others = read_live(spark, path).where(touched).join(keys, on=D.key_match(), how="left_anti")
        TB.write_pending(others.unionByName(fresh), path)
        TB.redo(spark, path, lambda rows: _swap_in(rows, path))


def keep_latest(spark: SparkSession, typed_path: str, live_path: str, checkpoint: str) -> int:
    """Take in all files of the typed table not seen before, then stop. Returns the
    number of rows read. ``checkpoint`` holds the state: shared storage."""
    own = SESSION.scoped(spark)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = own.readStream.schema(S.TYPED_SCHEMA).option("basePath", typed_path).parquet(typed_path)
    query = (
        latest(TB.in_table_order(rows))
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: put_winners(batch, live_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(int(p["numInputRows"] if isinstance(p, dict) else p.numInputRows) for p in query.recentProgress)
