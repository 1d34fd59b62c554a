"""Near-duplicate components and substring removal against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import near_dedup, suffix_dedup
from eventlake.llm.components import components


def plain_components(rows, size, num, den):
    sets = [near_dedup.shingle_set((t or "").encode().lower().split(), size) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[top(i)]) for i in range(len(rows))), key=str)


def near_rows(docs, size, num, den):
    got = near_dedup.near_duplicates(docs, size, num, den).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in got), key=str)


def random_docs(seed, n=120):
    """Chains of small edits, copies, and short texts from few words."""
    rng = random.Random(seed)
    rows, words = [], [f"v{i}" for i in range(400)]
    while len(rows) < n:
        text = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
    return rows + [(len(rows) + i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))) for i in range(40)]


@pytest.mark.parametrize("turns", [2, 0])
def test_components_equal_all_pairs(spark, monkeypatch, turns):
    monkeypatch.setattr(near_dedup, "STAR_TURNS", turns)
    rows = random_docs(turns)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert near_rows(df, 3, 85, 100) == plain_components(rows, 3, 85, 100)


@pytest.mark.parametrize("changed,together", [(13, False), (9, False), (2, True)])
def test_pairs_of_large_groups_stay_linear(spark, monkeypatch, changed, together):
    """2,000 texts that are near misses at 0.8, or near copies."""
    rng, base, rows = random.Random(3), [f"b{i}" for i in range(400)], []
    for k in range(2000):
        text = list(base)
        for j, at in enumerate(rng.sample(range(0, 400, 3), changed)):
            text[at] = f"own{k}x{j}"
        rows.append((k, " ".join(text)))
    seen, real = [], near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *a: (seen.append(pairs.count()), real(pairs, *a))[1])
    out = near_rows(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85, 100)
    assert len({c for _, _, c in out}) == (1 if together else 2000)
    assert sum(seen) <= 4 * len(rows)


def test_sizes_of_components_are_counted_once(spark, monkeypatch):
    """The lists that a turn reads several times join the components as they were written."""
    plans, made = [], near_dedup.star_pairs

    def star_pairs(lists, *args):
        plans.append(lists._jdf.queryExecution().optimizedPlan().toString())
        return made(lists, *args)

    monkeypatch.setattr(near_dedup, "star_pairs", star_pairs)
    rows = random_docs(3)
    assert near_rows(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 60, 100) == plain_components(rows, 3, 60, 100)
    assert "Join" in plans[-1]
    for plan in plans:
        assert plan.count("Join") <= 1 and "Aggregate" not in plan


def test_components_of_odd_rows(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert near_rows(docs, 5, 80, 100) == plain_components(rows, 5, 80, 100)


def test_one_of_each_group_stays(docs):
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.first()["_hash"] == 1
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    ids = [i for i, _ in got]
    assert 0 in ids and 1 not in ids and 15 not in ids and 7 not in ids and 10 not in ids
    assert ids.count(12) == 1 and ids.count(11) == 2
    assert {3, 4, 5} <= set(ids) and (None, None) in got and (None, "no id at all but words") in got
    assert near_dedup.keep_one(docs.limit(0)).count() == 0


def test_matches_needed():
    for num in (80, 85, 95):
        t = near_dedup.needed_matches(num, 100)
        assert 1 <= t <= near_dedup.K and near_dedup.needed_matches(num + 4, 100) >= t


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)]
    got = {r["node"]: r["label"] for r in components(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[200] == got[150] == got[100] == 100


def plain_removed(rows):
    """(doc_id, n_bytes, n_removed, n_spans, digest); distinct rows in (id, order)."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - 99):
            w = data[j : j + 100]
            if w in seen:
                gone[j : j + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        out[key] = (len(data), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    return out


def repeat_docs(seed):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdefgh é") for _ in range(260))
    rows = []
    for i in range(60):
        text = "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 300)))
        for _ in range(rng.randint(0, 3)):
            cut = rng.randint(0, 120)
            at = rng.randint(0, len(text))
            text = text[:at] + passage[cut : cut + rng.randint(60, 200)] + text[at:]
        rows.append((i * 3 - 20, text))
    return rows + [(500, "ab" * 400), (501, "b" * 99), (502, "c" * 350), (503, rows[5][1]), (504, None), (505, "")]


@pytest.mark.parametrize("segment", [1 << 18, 150])
def test_removed_bytes_equal_brute_force(spark, folder, monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    rows = repeat_docs(segment)
    spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as at", "'x' as _block").repartition(5).write.parquet(f"{folder}/documents.parquet")
    # segments are cut in the worker, which reads the module anew: cut the pieces here instead
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.query(spark, str(folder)).collect()}
    assert got == plain_removed(rows)


@pytest.mark.parametrize("key", [None, 7])
def test_many_texts_of_one_id(spark, key):
    """Equal to brute force for more texts of a doc_id than 13 bits number."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(130)
    rows = spark.createDataFrame([(key, word(12) + passage + word(12), i) for i in range(9000)], "doc_id bigint, text string, i int").repartition(4, "i").cache()
    order = [(r["i"], r["text"]) for r in rows.orderBy(F.xxhash64(F.col("text").cast("binary"))).collect()]
    got = {r["i"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in suffix_dedup.remove_repeats(rows).collect()}
    assert got == {i: want[3] for i, want in plain_removed(order).items()}
    numbered = suffix_dedup._numbered(rows.selectExpr("doc_id", "cast(text as binary) as _text"))
    assert numbered.select(suffix_dedup._block("_d", "_sub", 8)).distinct().count() == 8


def test_segments_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 130)
    texts = [b"a" * 400, b"short", bytes(range(256)) * 3, b""]
    seen = set()
    for who, base, part in suffix_dedup._pieces(texts):
        owner, start, n, _, _ = suffix_dedup.regions(part)
        for o, s, m in zip(owner.tolist(), start.tolist(), n.tolist()):
            for j in range(s, s + m - suffix_dedup.SPAN + 1):
                place = (who[o], base[o] + j)
                assert place not in seen
                seen.add(place)
    assert seen == {(k, j) for k, t in enumerate(texts) for j in range(len(t) - 99)}


def test_levels_merge_geometrically(spark):
    df = spark.createDataFrame([(i, f"{i} " * 60) for i in range(8)], "doc_id bigint, text string")
    from eventlake.llm.common import ship

    rows = suffix_dedup._numbered(df.selectExpr("doc_id", "cast(text as binary) as _text"))
    ship(spark)
    family, ranks = suffix_dedup.Family(spark), []
    for i in range(4):
        family.add(suffix_dedup.suffixes(rows.filter(f"doc_id div 2 = {i}")))
        ranks.append(sorted(family.levels))
    assert ranks == [[0], [1], [0, 1], [2]] and family.merges == 3


def test_odd_rows_lose_only_repeats(docs):
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        assert (r["_text"], r["_hash"], r["_row"], r["at"]) == ("t", 1, "r", 5)
        got.setdefault(r["doc_id"], []).append(r["text"])
    assert len(got[12]) == 2 and got[12][0] == got[12][1] and len(got[12][0]) < 130
    assert got[3] == [None] and got[4] == [""] and got[2] == ["unlike all others, this text has its own words only"]
    assert "same id, other text" in got[11] and got[15][0] == "" and "tail" in got[10][0]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_components_grow_by_later_links(spark):
    """Links in portions give the components of all of them, and what was joined
    before is not gone through again."""
    from eventlake.llm.components import extended

    rng = np.random.default_rng(11)
    pairs = [tuple(int(x) for x in rng.choice(120, 2, replace=False)) for _ in range(90)]
    labels = None
    for at in range(0, 90, 30):
        labels = extended(spark, labels, spark.createDataFrame(pairs[at : at + 30], "a bigint, b bigint"))
        want = components(spark, spark.createDataFrame(pairs[: at + 30], "a bigint, b bigint"))
        assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, want.collect()))
    # a chain that is joined already is one node of the later round
    chain = extended(spark, None, spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("later-link", "")
    more = extended(spark, chain, spark.createDataFrame([(40, 99)], "a bigint, b bigint"))
    n = len(jobs.getJobIdsForGroup("later-link"))
    spark.sparkContext.setJobGroup("all-links", "")
    components(spark, spark.createDataFrame([(i, i + 1) for i in range(40)] + [(40, 99)], "a bigint, b bigint"))
    assert n < len(jobs.getJobIdsForGroup("all-links"))
    assert {tuple(r) for r in more.collect()} == {(i, 0) for i in [*range(41), 99]}


def test_distinct_is_unique():
    from eventlake.llm.common import distinct

    rng = np.random.default_rng(12)
    for n in (0, 1, 7, 5000):
        for kind in (np.uint64, np.int64):
            values = rng.integers(0, 1 + n // 2, n).astype(kind)
            assert (distinct(values) == np.unique(values)).all()
