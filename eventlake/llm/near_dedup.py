"""Near-duplicate components by a signature-coordinate inverted join.

1. Every document gets the set of its distinct word shingles and a MinHash
   signature of ``K`` coordinates. Documents with equal sets are one class.
2. A class is posted under each (coordinate, value). A pair above the
   similarity matches in at least T of K coordinates (T is so low that a pair
   at the threshold is missed with a probability under ``MISS``).
3. Prefix: with one global order (shortest list first), such a pair shares a
   list among the first K - T + 1 of both. Only these lists are merged; the
   T - 1 longest of a document are skipped and looked up only when a pair's
   matches are counted on the signatures.
4. Linear passes: each member of a list may be tried with one of them, chosen by
   hash for each list anew, and takes of those of all its lists the one that
   it matches best; pairs are confirmed on the full texts, and components are
   formed. A pass makes a pair a class at most, however large its groups are.
5. Exact pass: what remains are pairs of one list in different components. The
   members outside the largest component of a list are tried with all others;
   a pair is made once, and only if it has T matches, and if what either class
   has for itself leaves enough to share: shingles that no other class with
   lists has are counted over the full sets, and no pair can share them; the
   others are counted in ``LOADS`` parts of the hash range, and a pair shares at
   most the smaller count of each part. Texts that differ from each other, be
   they ever so many and just under the similarity, so make few pairs. Components
   are formed again, and no link between different components is left.

Defined results: null or empty texts and texts without words have the empty
set and no links; texts shorter than a shingle are one shingle; null doc_ids
never name a component that has another id; repeated rows share a component;
extra columns are ignored; an empty table gives no rows. A very long text is one
row of one task, whose hashes take about twice its bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import distinct, drop_held, release, ship, staged, staged_count, table, unwrapped
from eventlake.llm.components import extended

K = 32
MISS = 1e-7
#: Linear passes before the exact one.
STAR_TURNS = 3
#: Parts of the hash range in which a class's shared shingles are counted.
LOADS = 64

_STATE = np.random.RandomState(20240101)
_A = _STATE.randint(0, 2**63, K, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _STATE.randint(0, 2**63, K, dtype=np.int64).astype(np.uint64)
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def needed_matches(num: int, den: int, k: int = K, miss: float = MISS) -> int:
    """Largest T with P(matches < T) <= ``miss`` for a pair at the threshold."""
    p, below, t = num / den, 0.0, 0
    while t < k:
        below += math.comb(k, t) * p**t * (1 - p) ** (k - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


class Shingler:
    """Hashes of distinct shingles; the hashes of words are kept up to a bound."""

    def __init__(self, size: int, most: int = 500_000):
        self.size, self.most, self.known = size, most, _WordHashes()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.most:
            known.clear()
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(words))
        out = h[: len(h) - n + 1].copy()
        for i in range(1, n):
            out = (out ^ (out >> np.uint64(29))) * _MIX[0] + h[i : len(h) - n + 1 + i] * _MIX[1]
        out ^= out >> np.uint64(32)
        out *= _MIX[0]
        return distinct(out ^ (out >> np.uint64(31)))

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(K, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), 4096):
            low = np.minimum(low, (hashes[at : at + 4096, None] * _A + _B).min(axis=0))
        return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    n = min(size, len(words))
    return set(zip(*(words[i:] for i in range(n)))) if n else set()


def signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, sig); ``node`` is a 128-bit digest
    of the shingle set, null without shingles."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        shingler = Shingler(shingle_words)
        for batch in batches:
            sizes, nodes, sigs = [], [], []
            for text in batch.column("_text"):
                hashes = shingler.hashes(words_of(text.as_py()))
                sizes.append(len(hashes))
                nodes.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                sigs.append(shingler.signature(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "text_hash", "n_shingles", "node", "sig"],
            )

    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, n_shingles bigint, node binary, sig array<int>")


def _near_size(a: str, b: str, num: int, den: int) -> Column:
    """Sets that may reach the similarity: the smaller has its share of the larger."""
    return den * F.least(a, b) >= num * F.greatest(a, b)


def postings(classes: DataFrame, t: int) -> DataFrame:
    """(node, n, keys, width): the lists that a class shares with others, in the
    global order (shortest first); its prefix are the first ``width`` of them.
    Lists of its own come first in the order and take places of the prefix."""
    rows = classes.select("node", "n", F.posexplode("sig").alias("c", "v")).select(
        "node", "n", F.expr("shiftleft(cast(c as bigint), 32) | (cast(v as bigint) & 4294967295L)").alias("key")
    )
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = rows.join(sizes, "key").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("size", "key"))).alias("e"))
    shared = shared.filter(F.size("e") >= t).select("node", "n", F.expr("transform(e, x -> x.key)").alias("keys"))
    return shared.withColumn("width", F.size("keys") - t + 1)


def with_components(posted: DataFrame, sized: DataFrame | None) -> DataFrame:
    """``posted`` with the component of each class and its size, from ``sized`` (node,
    label, size); a class that is not there, or with no links yet (``None``) any, is
    a component of its own."""
    if sized is None:
        return posted.withColumn("label", F.col("node")).withColumn("size", F.lit(1).cast("long"))
    rows = posted.join(sized, "node", "left")
    return rows.withColumn("label", F.coalesce("label", "node")).withColumn("size", F.coalesce("size", F.lit(1).cast("long")))


def in_lists(posted: DataFrame) -> DataFrame:
    return posted.withColumn("key", F.explode(F.expr("slice(keys, 1, width)")))


def matching(t: int, a: str = "a", b: str = "b") -> Column:
    """Whether two classes match in ``t`` coordinates; lists of their own never do."""
    return F.size(F.array_intersect(f"{a}.keys", f"{b}.keys")) >= t


def confirmed(pairs: DataFrame, texts: DataFrame, shingle_words: int, num: int, den: int) -> DataFrame:
    """Pairs whose full shingle sets reach num / den, compared as words."""
    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("_tb")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        last, kept = None, set()
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("_ta"), batch.column("_tb")):
                if (text := y.as_py()) != last:
                    last, kept = text, shingle_set(words_of(text), shingle_words)
                other = shingle_set(words_of(x.as_py()), shingle_words)
                both = len(kept & other)
                keep.append(den * both >= num * (len(kept) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "_ta", "_tb").mapInArrow(run, "a binary, b binary")


def linkable(posted: DataFrame, texts: DataFrame, shingle_words: int, num: int, den: int) -> DataFrame:
    """``posted`` with the number ``own`` of each class's shingles that no other
    posted class has, which are in no intersection, and the ``loads``, the others
    counted in parts of the hash range; without the classes that have too many of
    their own to reach the similarity with anybody."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        shingler = Shingler(shingle_words)
        for batch in batches:
            sets = [shingler.hashes(words_of(t.as_py())).view(np.int64) for t in batch.column("text")]
            ids = np.repeat(batch.column("id").to_numpy(), [len(g) for g in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([*sets, np.empty(0, np.int64)]))], ["id", "g"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        shingler = Shingler(shingle_words)
        for batch in batches:
            sets = [shingler.hashes(words_of(t.as_py())).view(np.int64) for t in batch.column("text")]
            counts = [np.bincount(g % LOADS, minlength=LOADS).astype(np.int32) for g in sets]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("id"), pa.array(counts, pa.list_(pa.int32()))], ["node", "id", "parts"])

    texts = texts.withColumn("id", F.xxhash64("node"))
    places = texts.select("id", "text").mapInArrow(run, "id bigint, g bigint")
    alone = places.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).filter("c = 1")
    by_part = alone.groupBy("id", F.pmod("g", F.lit(LOADS)).cast("int").alias("part")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    # at most LOADS entries a class
    own = by_part.groupBy("id").agg(F.sum("n").alias("own"), F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("own_parts"))
    counted = texts.select("node", "id", "text").mapInArrow(parts, "node binary, id bigint, parts array<int>").join(own, "id", "left")
    counted = counted.select("node", F.coalesce("own", F.lit(0)).alias("own"), F.expr("transform(parts, (x, i) -> x - coalesce(try_element_at(own_parts, i), 0))").alias("loads"))
    return posted.join(counted, "node").filter(den * (F.col("n") - F.col("own")) >= num * F.col("n"))


_MEMBER = ("node", "n", "own", "label", "keys", "width")


def _may_link(a: str, b: str, num: int, den: int) -> Column:
    """Sets whose sizes allow the similarity, and so does what they may share."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(n - F.col(f"{a}.own"), m - F.col(f"{b}.own"))
    return _near_size(f"{a}.n", f"{b}.n", num, den) & ((num + den) * rest >= num * (n + m))


def star_pairs(lists: DataFrame, t: int, num: int, den: int, turn: int) -> DataFrame:
    """Each class with the head of one of its lists, that which it has most matches
    with. A list's head is chosen by hash, anew for every list and turn, from its
    largest component. At most one pair a class."""
    pick = F.struct("size", "label", F.xxhash64("node", "key", F.lit(turn)).alias("by"), F.struct(*_MEMBER).alias("b"))
    heads = lists.groupBy("key").agg(F.max(pick).alias("h")).select("key", F.col("h.b").alias("b"), F.col("h.size").alias("size"))
    rows = lists.select("key", F.struct(*_MEMBER).alias("a")).join(heads, "key").filter("a.label != b.label").filter(_may_link("a", "b", num, den))
    rows = rows.select("a.node", F.col("b.node").alias("other"), F.size(F.array_intersect("a.keys", "b.keys")).alias("same"), "size").filter(F.col("same") >= t)
    best = rows.groupBy("node").agg(F.max(F.struct("same", "size", "other")).alias("m"))
    return best.select(F.least("node", "m.other").alias("a"), F.greatest("node", "m.other").alias("b")).distinct()


def residual_pairs(lists: DataFrame, t: int, num: int, den: int) -> DataFrame:
    """All pairs of a list that are in different components, each once: members
    outside the list's largest component against all. A pair is made by the
    first list that both prefixes have."""
    largest = lists.groupBy("key").agg(F.max(F.struct("size", "label")).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    largest = largest.filter("lo != hi").select("key", F.col("m.label").alias("most"))
    rows = lists.select("key", F.struct(*_MEMBER, "loads").alias("a")).join(largest, "key")
    few, every = rows.filter("a.label != most"), rows.select("key", F.col("a").alias("b"))
    first = F.expr("element_at(array_intersect(slice(a.keys, 1, a.width), slice(b.keys, 1, b.width)), 1) = l.key")
    once = F.expr("a.label != b.label and (b.label = most or a.node < b.node)")
    # what both may share at most, part by part
    shared = F.expr("aggregate(zip_with(a.loads, b.loads, (x, y) -> least(x, y)), 0, (s, x) -> s + x)")
    near = _may_link("a", "b", num, den) & ((num + den) * shared >= num * (F.col("a.n") + F.col("b.n")))
    left, right = few.alias("l"), every.alias("r")
    joined = left.join(right, (F.col("l.key") == F.col("r.key")) & once & near & matching(t) & first)
    return joined.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, text_hash, node, n_shingles, component_id, leader): per row of
    (doc_id, text) its class, the smallest doc_id of its component and whether
    its class is the one that holds that document."""
    spark = ship(docs.sparkSession)
    t = needed_matches(num, den)
    signed = staged(spark, signatures(docs, shingle_words), "signatures")
    filled = signed.filter("node is not null")
    classes = staged(
        spark,
        filled.groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least"),
            F.first("n_shingles").alias("n"),
            F.first("sig").alias("sig"),
        ).select("node", "n", "sig", F.col("least.doc_id").alias("doc_id"), F.col("least.text_hash").alias("text_hash")),
        "classes",
    )
    release(spark)
    posted = staged(spark, postings(classes, t), "postings")
    release(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))

    # a class that shares fewer than T lists has no partner; of the others, one text each
    wanted = posted.select("node").join(classes.select("node", "doc_id", "text_hash"), "node")
    same = wanted["doc_id"].eqNullSafe(texts["doc_id"]) & (wanted["text_hash"] == texts["text_hash"])
    fetched = staged(spark, wanted.join(texts, same).groupBy("node").agg(F.first("text").alias("text")), "texts")
    release(spark)
    posted = staged(spark, linkable(posted, fetched, shingle_words, num, den), "linkable")
    release(spark)

    labels = classes.select("node", F.col("node").alias("label")).limit(0)
    joined = tried = sized = None
    for turn in range(STAR_TURNS + 1):
        lists = in_lists(with_components(posted, sized))
        fresh = residual_pairs(lists, t, num, den) if turn == STAR_TURNS else star_pairs(lists, t, num, den, turn)
        fresh, pairs = staged_count(spark, fresh.join(tried, ["a", "b"], "left_anti") if tried is not None else fresh, "pairs")
        release(spark)
        if not pairs:
            continue
        tried = fresh if tried is None else tried.unionByName(fresh)
        links, found = staged_count(spark, confirmed(fresh, fetched, shingle_words, num, den), "links")
        release(spark)
        if found:
            labels = joined = extended(spark, joined, links)
            release(spark)
            if turn < STAR_TURNS:
                sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
                sized = staged(spark, labels.join(sizes, "label").select("node", "label", "size"), "sized")
                release(spark)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    named = classes.select("node", "doc_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = named.groupBy("label").agg(least.alias("least"))
    by_class = named.join(heads, "label").select("node", F.col("least.doc_id").alias("component_id"), (F.col("least.node") == F.col("node")).alias("leader"))
    return signed.select("doc_id", "text_hash", "n_shingles", "node").join(by_class, "node", "left").select(
        "doc_id",
        "text_hash",
        "node",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("leader", F.lit(True)).alias("leader"),
    )


def keep_one(docs: DataFrame, shingle_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with all columns and one row of each component: that of the
    smallest doc_id (of equal rows, any). Rows without words all stay."""
    found = near_duplicates(docs, shingle_words, num, den).filter("node is null or leader")
    # rows with one (doc_id, text) are one choice; the text decides among equal doc_ids
    first = found.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least"))
    kept = first.select(F.col("least.doc_id").alias("_keep"), F.col("least.text_hash").alias("_keephash"))
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_hash"),
        F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("_words"),
    )
    same = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_hash") == F.col("_keephash"))
    once = rows.filter("_words").join(kept, same, "left_semi").dropDuplicates(["_id", "_hash"])
    return unwrapped(once.unionByName(rows.filter("not _words")), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, num=85, den=100)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
                               WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
    FROM w)),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM pr JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d)
SELECT n.doc_id, n.n AS n_shingles, c AS component_id, n.doc_id = c AS kept
FROM n JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) ON d = n.doc_id
"""
