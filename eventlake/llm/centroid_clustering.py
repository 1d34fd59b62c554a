"""Centroid clustering with nearest centroids found by the threshold algorithm.

Vectors are turned into integers, so distances, sums and means are exact and
do not depend on the order in which tasks finish.

Nearest centroid of a vector: every dimension has the centroids in a list
sorted by their value. From the vector's own value each list is walked
outward, the nearer neighbour first. A centroid met for the first time gets
its exact distance. The squared steps of the frontiers of all lists sum up to
a bound that no centroid still unmet can be below; the walk ends when the bound
strictly exceeds the best distance, so that ties (the smaller number wins) have
all been met. All vectors of a batch walk at once, in numpy; those that are
done leave.

A round reads the staged integer vectors once. A task adds up the vectors of
each cluster and sends one row a cluster; the driver sees ``k`` sums. Rows are
never shuffled.

Defined results: vectors with another number of components, a null vector, or a
null or non-finite component are left out; rows with a null id are clustered
like others and are first centroids only after all others; rows with one id are
each clustered, and where they tie for a first centroid the smaller components
go first; fewer rows than ``k`` give fewer centroids; equal centroids stay,
the smaller number gets the vectors; empty tables give no rows; further columns
are ignored. A component beyond 2^26 after scaling is an error, as squares
would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import drop_held, ship, staged, table

DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
#: 64 squared differences of numbers up to this bound fit a long.
LIMIT = 1 << 26
#: Vectors that walk at once.
CHUNK = 2048
_FAR = np.int64(1) << 40  # beyond any difference: the end of a list
#: Centroids are part of every task; more than this is no "few centroids" any more.
MAX_CENTROID_BYTES = 64 << 20


def quantised(vectors: DataFrame, id_column: str, vector_column: str, dims: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, q): the vectors that count, as arrays of floor(scale * component)."""
    number = lambda x: x.cast("double")
    whole = lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf"))
    beyond = F.raise_error(F.lit(f"a component is beyond {LIMIT} / {scale}")).cast("int")
    whole_number = lambda x: F.when(F.abs(scale * number(x)) <= LIMIT, F.floor(scale * number(x)).cast("int")).otherwise(beyond)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & (F.size("_v") == dims)).where(F.forall("_v", whole))
    return rows.select("id", F.transform("_v", whole_number).alias("q"))


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids, in hash order."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    top = rows.select("q", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "q").limit(k)  # k rows
    return np.array([r["q"] for r in top.collect()], np.int64)


class Walk:
    """The sorted lists of the centroids, and the walk of many vectors along them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        ends = np.full((1, centroids.shape[1]), _FAR)
        # one value beyond either end, so that a frontier that left a list stays far
        self.values = np.concatenate([-ends, np.take_along_axis(centroids, self.order, 0), ends])
        self.met = 0

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row of ``v``."""
        parts = [self._nearest(v[at : at + CHUNK]) for at in range(0, len(v), CHUNK)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, dims = v.shape
        k = len(self.centroids)
        best, found = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        seen = np.zeros((n, k), bool)
        columns = np.arange(dims)
        up = np.empty((n, dims), np.int64)  # next place to the right in ``values``
        for d in range(dims):
            up[:, d] = np.searchsorted(self.values[:, d], v[:, d])
        down = up - 1
        live = np.arange(n)
        for _ in range(k):
            at = v[live]
            left, right = at - self.values[down, columns], self.values[up, columns] - at
            nearer = left <= right
            step = np.where(nearer, left, right)
            # of a list with k entries, k steps stay within it
            who = self.order[np.where(nearer, down, up) - 1, columns]
            down, up = down - nearer, up + ~nearer
            new = np.zeros((len(live), k), bool)
            np.put_along_axis(new, who, True, 1)
            new &= ~seen[live]
            row, c = np.nonzero(new)
            self.met += len(row)
            gap = at[row] - self.centroids[c]
            far = np.einsum("ij,ij->i", gap, gap)
            seen[live] |= new
            exact = np.full((len(live), k), np.iinfo(np.int64).max)
            exact[row, c] = far
            low = exact.argmin(1)  # of equal distances the smallest number
            d = exact[np.arange(len(live)), low]
            better = (d < best[live]) | ((d == best[live]) & (low < found[live]))
            best[live[better]], found[live[better]] = d[better], low[better]
            on = (step * step).sum(1) <= best[live]
            if not on.any():
                break
            live, down, up = live[on], down[on], up[on]
        return found, best


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    q = batch.column("q")
    return q.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(q), -1)


def _sent(centroids: np.ndarray) -> np.ndarray:
    if centroids.nbytes > MAX_CENTROID_BYTES:
        raise ValueError(f"{centroids.nbytes} bytes of centroids are more than a task gets")
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every row of ``rows`` (id, q)."""
    centroids = _sent(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        walk = Walk(centroids)
        for batch in batches:
            if not len(batch):
                continue
            c, d = walk.nearest(_matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(c, pa.int32()), pa.array(d, pa.int64())], ["id", "cluster", "distance"])

    return rows.mapInArrow(run, "id bigint, cluster int, distance bigint")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of each cluster's vectors,
    empty clusters as they were."""
    k, dims = centroids.shape
    centroids = _sent(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        walk, total, count = Walk(centroids), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            v = _matrix(batch)
            c, _ = walk.nearest(v)
            count += np.bincount(c, minlength=k)
            order = np.argsort(c, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(c[order]) > 0])
            total[c[order][starts]] += np.add.reduceat(v[order], starts, axis=0)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(count[full], pa.int64()), pa.array(total[full].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    # a row a cluster from each task; sums as decimals, which no number of rows exceeds
    sums = rows.mapInArrow(run, "cluster int, n bigint, total array<bigint>").select("cluster", "n", F.posexplode("total").alias("d", "x"))
    sums = sums.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = centroids.copy()
    for r in sums.collect():  # k * dims rows
        out[r["cluster"], r["d"]] = int(r["x"]) // int(r["n"])
    return out


def clustered(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", dims: int = DIMENSIONS, scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every vector that counts, final centroids)."""
    spark = ship(vectors.sparkSession)
    rows = staged(spark, quantised(vectors, id_column, vector_column, dims, scale), "vectors")
    centroids = first_centroids(rows, k)
    if not len(centroids):
        return spark.createDataFrame([], "id bigint, cluster int, distance bigint"), centroids
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    return staged(spark, assign(rows, centroids), "assigned"), centroids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(table(spark, sf_dir, "embeddings"))
    names = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    sizes = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia"))
    known = [(r["cluster"], r["cluster_inertia"]) for r in sizes.collect()]  # a row a cluster
    every = sum(x for _, x in known)
    by = {c: x for c, x in known}
    facts = spark.createDataFrame([(i, by.get(i, 0), every, h) for i, h in names], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = found.join(F.broadcast(facts), "cluster")  # a row a centroid
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(dims: int, scale: int, k: int, rounds: int) -> str:
    """The rounds written out, one pair of steps each."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims}),
c0 AS MATERIALIZED (
  SELECT q, row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c FROM v ORDER BY sha256('1:' || vec_id), q LIMIT {k})"""
    ]
    square = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q, CAST(arg_min(c, (d, c)) AS INTEGER) AS c, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT v.r, v.vec_id, v.q, c.c, CAST({square} AS BIGINT) AS d FROM v, c{i} AS c) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT c, list(m ORDER BY i) AS q FROM (
    SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{i}) GROUP BY c, i) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT coalesce(m.q, c.q) AS q, c.c FROM c{i} AS c LEFT JOIN m{i} AS m ON m.c = c.c)""")
    last = rounds
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.q, ',')) AS centroid_sha256
FROM a{last} AS a JOIN c{last} AS k ON k.c = a.c
"""
    )


ORACLE = _oracle(DIMENSIONS, SCALE, CENTROIDS, ROUNDS)
