"""Deduplication and upsert without a shuffle, on bucketed catalog tables.

The event key and the serving key both begin with ``request_id``. Tables bucketed
by it are dealt by key once, when they are written; every later window or merge
over them is done bucket by bucket, in place. Within a bucket file rows are
sorted by the key.

A bucket is one task. A request with very many copies makes a large one: the
write drops all but the newest copy in each of its tasks first
(``WindowGroupLimit``, as in ``dedupe``) when ``newest`` is set, and what remains
is sorted with spilling. Choose ``buckets`` as table size / 200 MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.operators import dedupe as D
from eventlake.operators import serve as SV

BUCKET_KEY = "request_id"
#: What these plans need of a session (the caller's stays as it is).
SETTINGS = {
    # take buckets as they are, whatever their size and number
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # two tables dealt by one of the join's keys are dealt alike
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def session_for(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    for key, value in {**dict(spark.conf.getAll), **SETTINGS}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def write_bucketed(rows: DataFrame, name: str, location: str, buckets: int, sort: list[str] = S.DEDUPE_KEY, newest: bool = False) -> None:
    """Write ``rows`` as the catalog table ``name``. One file a bucket: rows are dealt
    by the bucket key before the write."""
    dealt = D.newest_first(rows) if newest else rows
    (
        dealt.repartition(buckets, BUCKET_KEY)
        .write.mode("overwrite")
        .bucketBy(buckets, BUCKET_KEY)
        .sortBy(*sort)
        .option("path", location)
        .format("parquet")
        .saveAsTable(name)
    )


def newest_in_buckets(spark: SparkSession, name: str) -> DataFrame:
    """D1 over a bucketed table: no exchange."""
    return D.newest_first(session_for(spark).table(name))


def upsert_in_buckets(spark: SparkSession, old: str, new: str, key: list[str] = S.SERVING_KEY) -> DataFrame:
    """U1 over two tables bucketed alike: no exchange. The new rows are reduced to
    one a key within their buckets; an outer merge of both sides takes the new
    row of a key that has one."""
    own = session_for(spark)
    left, right = own.table(old), own.table(new)
    columns = left.columns
    order = [F.col(c).desc_nulls_last() for c in S.SERVING_ORDER] + [F.xxhash64(*[F.col(c) for c in columns]).desc()]

    def one_a_key(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*[F.col(c) for c in key]).orderBy(*order)
        return rows.withColumn(SV.RANK, F.row_number().over(w)).where(F.col(SV.RANK) == 1).drop(SV.RANK)

    was = one_a_key(left).select(F.struct(*columns).alias("_was"), *[F.col(c).alias(f"_was_{c}") for c in key])
    now = one_a_key(right.select(*columns)).select(F.struct(*columns).alias("_now"), *[F.col(c).alias(f"_now_{c}") for c in key])
    same = [F.col(f"_was_{c}") == F.col(f"_now_{c}") for c in key]  # serving keys have no NULL
    merged = was.join(now.hint("merge"), on=same, how="full_outer")
    return merged.select(F.coalesce("_now", "_was").alias("r")).select("r.*")
