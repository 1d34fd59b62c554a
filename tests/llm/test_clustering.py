"""Nearest centroids and rounds against plain loops."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import centroid_clustering as CC


def plain(rows, dims, scale, k, rounds):
    """rows of (id, vector): ({position: (cluster, distance)}, centroids)."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(q) for _, q in sorted(kept, key=key)[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(q)[1] for _, q in kept]
        for n in range(len(centroids)):
            mine = [q for c, (_, q) in zip(of, kept) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, nearest(q)[1], nearest(q)[0]) for i, q in kept]
    return sorted(out, key=str), centroids


@pytest.mark.parametrize("seed,k,spread", [(0, 5, 1.0), (1, 16, 0.05), (2, 40, 3.0)])
def test_walk_finds_the_nearest(seed, k, spread):
    rng = np.random.default_rng(seed)
    c = np.floor(64 * rng.normal(0, spread, (k, 64))).astype(np.int64)
    c[k // 2] = c[0]  # equal centroids: the smaller number
    v = np.concatenate([c[rng.integers(0, k, 60)] + rng.integers(-2, 3, (60, 64)), rng.integers(-90, 90, (60, 64)), c])
    far = ((v[:, None] - c[None]) ** 2).sum(2)
    walk = CC.Walk(c)
    got, d = walk.nearest(v)
    assert (got == far.argmin(1)).all() and (d == far.min(1)).all()
    assert walk.met <= far.size


def test_the_walk_ends_early_where_it_can():
    c = np.arange(100, dtype=np.int64)[:, None] * 50 + np.zeros((1, 8), np.int64)
    walk = CC.Walk(c)
    walk.nearest(c + 1)
    assert walk.met < 4 * len(c)  # not all 100 * 100 distances


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 4) + 3 * (i % 3)).tolist()) for i in range(80)]
    rows += [(7, [0.5, 0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5, 0.5]), (None, [1.0, 2.0, 3.0, 4.0]), (90, None), (91, []), (92, [1.0, 2.0, 3.0])]
    rows += [(93, [1.0, None, 2.0, 3.0]), (94, [1.0, math.nan, 2.0, 3.0]), (95, [1.0, -math.inf, 2.0, 3.0]), (96, [0.0] * 5), (-5, [-0.0, -1e-9, 0.0, 1e-9])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, q string")
    for k, rounds in ((6, 3), (200, 2), (1, 1)):
        found, centroids = CC.clustered(df, dims=4, scale=16, k=k, rounds=rounds)
        want, middle = plain(rows, 4, 16, k, rounds)
        assert sorted(map(tuple, found.collect()), key=str) == want and centroids.tolist() == middle
    found, centroids = CC.clustered(df.limit(0), dims=4)
    assert found.count() == 0 and found.columns == ["id", "cluster", "distance"] and len(centroids) == 0
    with pytest.raises(Exception, match="beyond"):
        CC.clustered(df.select("vec_id", F.transform("embedding", lambda x: x * 1e12).alias("embedding")), dims=4)


def test_query_on_an_empty_table(spark, folder):
    spark.createDataFrame([], "vec_id bigint, embedding array<float>").write.parquet(str(folder / "embeddings.parquet"))
    assert CC.query(spark, str(folder)).count() == 0
