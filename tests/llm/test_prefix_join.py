"""Grouped prefix join against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from eventlake.llm import prefix_join as PJ
from test_dedup import plain_components, random_docs


def found(docs, size, num, den):
    out = PJ.jaccard_components(docs, size, num, den).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in out), key=str)


@pytest.mark.parametrize("turns,size,num", [(3, 5, 80), (0, 5, 80), (1, 3, 60), (2, 1, 85)])
def test_components_equal_all_pairs(spark, monkeypatch, turns, size, num):
    monkeypatch.setattr(PJ, "TURNS", turns)
    monkeypatch.setattr(PJ, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(PJ, "SHARD_BYTES", 5000)
    rows = random_docs(turns + 10)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, size, num, 100) == plain_components(rows, size, num, 100)


def test_components_of_odd_rows(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, 5, 80, 100) == plain_components(rows, 5, 80, 100)
    assert PJ.jaccard_components(docs.limit(0)).count() == 0


def test_frequencies_of_shards(spark):
    """A block's answers are in the order of its hashes, and count documents."""
    rows = [(i, f"{'a b c ' * (i % 3)}w{i} w{i + 1}".encode(), i % 4) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text binary, block int")
    for bits in (0, 3):
        told = PJ.frequencies(df, 1, bits).collect()
        count, shingler = Counter(), PJ.Shingler(1)
        sets = [shingler.hashes(PJ.words_of(t)) for _, t, _ in rows]
        for s in sets:
            count.update(s.tolist())
        for block in range(4):
            mine = sorted({h for (_, _, b), s in zip(rows, sets) if b == block for h in s.tolist()})
            got = b"".join(r["rarity"] for r in sorted((r for r in told if r["block"] == block), key=lambda r: r["shard"]))
            assert list(got) == PJ.classes_of(np.array([count[h] for h in mine])).tolist()
    c = PJ.classes_of(np.arange(1, 100_000))
    assert (np.diff(c.astype(int)) >= 0).all() and c[0] == 1 and (c[1:63] == np.arange(2, 64)).all()


def near_misses(n, words, changed, rng):
    """Texts that differ from one base in words of their own."""
    base = [f"b{i}" for i in range(words)]
    out = []
    for k in range(n):
        text = list(base)
        for j, at in enumerate(rng.sample(range(0, words, 5), changed)):
            text[at] = f"own{k}x{j}"
        out.append((k, " ".join(text)))
    return out


@pytest.mark.parametrize("changed,together", [(10, False), (7, False), (2, True)])
def test_pairs_stay_linear(spark, monkeypatch, changed, together):
    """A group of 600 near misses or near copies makes no pairs by the square."""
    rows = near_misses(600, 400, changed, random.Random(2))
    seen = []
    real = PJ.confirmed
    monkeypatch.setattr(PJ, "confirmed", lambda pairs, *a: (seen.append(pairs.count()), real(pairs, *a))[1])
    out = found(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, 80, 100)
    assert len({c for _, _, c in out}) == (1 if together else 600)
    assert sum(seen) <= 4 * len(rows)


def test_query_equals_its_sql(spark):
    import duckdb

    from scales import SF_SMALL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    assert sorted(map(tuple, PJ.query(spark, SF_SMALL).collect())) == sorted(con.execute(PJ.ORACLE).fetchall())
