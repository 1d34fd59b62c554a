"""N-gram Jaccard join: a prefix join over groups of documents.

1. Frequencies. Documents are dealt to blocks by row. A block sends its distinct
   shingle hashes to shards of the hash range, packed; a shard adds up in how
   many documents each occurs and answers the block in the block's order, one
   byte a shingle. No shingle is ever a row.
2. Prefixes. Shingles have one global order, rarest first. Sets with a Jaccard
   similarity of num / den share one of their first n - ceil(n * num / den) + 1
   shingles; shingles of one document alone keep their place there but need no
   list. A document whose prefix is all its own has no partner.
3. Groups. Documents with equal sets are one class; classes with equal prefix
   and size are one group, posted once under each shingle of its prefix.
4. Group pairs. Two groups of a list are a pair if their sizes allow the
   similarity and so does the position of the common shingle: what comes after
   it in both is all they may still share.
5. Members. Pairs of groups are expanded to members and verified on the words of
   the full texts. Only components are asked for, so this goes in turns: a group
   is tried with one head among those of its lists, from the largest component,
   and a member with the first of its group. A last, exact pass makes all pairs
   of members that are still in different components, in lists that have some,
   and whose loads allow the similarity: shingles that other documents have are
   counted in ``LOADS`` parts of the hash range, and two sets share at most the
   smaller count of each part. No link between different components is left; a
   group of copies costs its size, not its square, and one of near misses makes
   few pairs.

Defined results: null and empty texts and texts without words have the empty
set and no links; texts shorter than a shingle are one shingle; very long texts
are one block (about 20 bytes are held a byte); null doc_ids never name a
component that has another id; repeated rows share a component; further columns
are ignored; an empty table gives no rows. Frequencies of shingles whose hashes
agree in a shard's 32 bits are added up, which moves both in the order and
changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import block_count, drop_held, release, row_block, ship, staged, staged_count, table
from eventlake.llm.components import extended
from eventlake.llm.near_dedup import Shingler, confirmed, words_of

#: Text of a block, and text whose shingles one shard counts.
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 16 << 20
#: Turns in which a group is tried with one head; the exact pass follows.
TURNS = 2
#: Parts of the hash range in which a set's shared shingles are counted.
LOADS = 64
#: Tasks that a shuffle is dealt to at most.
MOST_TASKS = 50_000
#: Frequencies up to this are told apart, higher ones by quarters of powers of two.
EXACT = 64


def classes_of(frequency: np.ndarray) -> np.ndarray:
    """One byte that rises with the frequency."""
    high = EXACT + np.floor(4 * np.log2(np.maximum(frequency, EXACT) / EXACT)).astype(np.int64)
    return np.minimum(np.where(frequency < EXACT, frequency, high), 255).astype(np.uint8)


def _shard_bits(texts: DataFrame) -> int:
    return (block_count(texts, "text", SHARD_BYTES) - 1).bit_length()


def _shards(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each hash, and the 32 bits after those of the shard."""
    shard = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    return shard, ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _sets(shingler: Shingler, texts: pa.ChunkedArray) -> list[np.ndarray]:
    return [shingler.hashes(words_of(t.as_py())) for t in texts]


def frequencies(rows: DataFrame, shingle_words: int, bits: int, blocks: int = 1) -> DataFrame:
    """(block, shard, rarity): for every block the classes of its distinct
    shingles, in the order of their hashes, by shard."""

    def ask(key: tuple, docs: pa.Table) -> pa.Table:
        drop_held()
        sets = _sets(Shingler(shingle_words), docs.column("text"))
        hashes, count = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
        shard, short = _shards(hashes, bits)
        count = np.minimum(count, 65535).astype(np.uint16)
        names, first = np.unique(shard, return_index=True)
        cut = [*first.tolist(), len(hashes)]
        parts = list(zip(cut, cut[1:]))
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(names), pa.int32()),
                "shard": pa.array(names, pa.int64()),
                "hashes": pa.array([short[a:b].tobytes() for a, b in parts], pa.binary()),
                "counts": pa.array([count[a:b].tobytes() for a, b in parts], pa.binary()),
            }
        )

    def answer(key: tuple, asked: pa.Table) -> pa.Table:
        drop_held()
        parts = [np.frombuffer(h.as_py(), np.uint32) for h in asked.column("hashes")]
        counts = np.concatenate([np.frombuffer(c.as_py(), np.uint16) for c in asked.column("counts")]).astype(np.int64)
        distinct, back = np.unique(np.concatenate(parts), return_inverse=True)
        rarity = classes_of(np.bincount(back, counts, len(distinct)).astype(np.int64))[back]
        cut = np.r_[0, np.cumsum([len(p) for p in parts])].tolist()
        return pa.table(
            {
                "block": asked.column("block"),
                "shard": asked.column("shard"),
                "rarity": pa.array([rarity[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
            }
        )

    asked = dealt(rows, "block", blocks).groupBy("block").applyInArrow(ask, "block int, shard bigint, hashes binary, counts binary")
    return dealt(asked, "shard", 1 << bits).groupBy("shard").applyInArrow(answer, "block int, shard bigint, rarity binary")


def dealt(df: DataFrame, column: str, groups: int) -> DataFrame:
    """Rows with the groups of ``column`` spread over tasks, one each where there
    are not very many; a task takes its groups one by one."""
    return df.repartition(min(max(1, groups), MOST_TASKS), column)


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


_SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, node binary, grp binary, keys array<bigint>, places array<int>, loads array<int>, text binary"


def prefixes(rows: DataFrame, rarities: DataFrame, shingle_words: int, num: int, den: int, blocks: int = 1) -> DataFrame:
    """Per document the size and digest of its set (``node``) and, if another
    document has a shingle of its prefix, its group, those shingles, their places
    in the order, its loads and its text."""
    names = [x.split()[0] for x in _SIGNED.split(", ")]

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        drop_held()
        sets = _sets(Shingler(shingle_words), docs.column("text"))
        every = np.concatenate([*sets, np.empty(0, np.uint64)])
        places_of = np.unique(every, return_inverse=True)[1]  # among the block's distinct hashes
        order = np.argsort(answers.column("shard").to_numpy()) if len(answers) else []
        told = answers.column("rarity")
        rarity = np.frombuffer(b"".join(told[int(i)].as_py() for i in order), np.uint8)[places_of]
        ends = np.cumsum([len(mine) for mine in sets]).tolist()
        nodes, groups, keys, places, loads, texts = [], [], [], [], [], []
        for mine, end, text in zip(sets, ends, docs.column("text")):
            node = group = key = place = load = kept = None
            if len(mine):
                node = hashlib.blake2b(mine.tobytes(), digest_size=16).digest()
                rare = rarity[end - len(mine) : end]
                first = np.argsort(rare, kind="stable")[: prefix_size(len(mine), num, den)]  # hashes are sorted
                shared = np.flatnonzero(rare[first] > 1)
                if len(shared):
                    prefix = mine[first]
                    group = hashlib.blake2b(prefix.tobytes(), digest_size=16, key=len(mine).to_bytes(8, "little")).digest()
                    key, place = prefix[shared].view(np.int64), shared.astype(np.int32)
                    load, kept = np.bincount((mine[rare > 1] % np.uint64(LOADS)).view(np.int64), minlength=LOADS).astype(np.int32), text
            nodes.append(node)
            groups.append(group)
            keys.append(key)
            places.append(place)
            loads.append(load)
            texts.append(kept)
        columns = [docs.column("doc_id"), docs.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()), pa.array(groups, pa.binary())]
        return pa.Table.from_arrays([*columns, pa.array(keys, pa.list_(pa.int64())), *[pa.array(x, pa.list_(pa.int32())) for x in (places, loads)], pa.array(texts, pa.binary())], names)

    rows, rarities = dealt(rows, "block", blocks), dealt(rarities, "block", blocks)
    return rows.groupBy("block").cogroup(rarities.groupBy("block")).applyInArrow(run, _SIGNED)


def _possible(a: str, b: str, num: int, den: int) -> Column:
    """Whether sets of these sizes with a common shingle at these places may reach
    the similarity, if it is their first common one."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place"))
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & ((num + den) * rest >= num * (n + m))


_POST = ("grp", "n", "place", "label", "size", "rep")


def head_pairs(lists: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """(a, b) of first members: each group with one head of its lists. A list's
    head is a group of its largest component; of several heads a group takes
    the one of the largest component, then the one by hash."""
    by = F.xxhash64("grp", F.lit(turn)) if turn == 0 else F.xxhash64("grp", "key", F.lit(turn))
    heads = lists.groupBy("key").agg(F.max(F.struct("size", "label", by.alias("by"), F.struct(*_POST).alias("b"))).alias("h"))
    rows = lists.select("key", F.struct(*_POST).alias("a")).join(heads.select("key", "h"), "key")
    rows = rows.select("a", F.col("h.b").alias("b"), F.col("h.by").alias("by")).filter("a.label != b.label").filter(_possible("a", "b", num, den))
    best = rows.groupBy(F.col("a.grp").alias("grp")).agg(F.max(F.struct("b.size", "by", "a.rep", F.col("b.rep").alias("other"))).alias("m"))
    return best.select(F.least("m.rep", "m.other").alias("a"), F.greatest("m.rep", "m.other").alias("b")).distinct()


def other_pairs(lists: DataFrame, loads: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of all members of a list in different components, each once: those
    outside the list's largest component with all others. ``lists`` holds
    members: (key, node, n, place, label, size)."""
    largest = lists.groupBy("key").agg(F.max(F.struct("size", "label")).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    largest = largest.filter("lo != hi").select("key", F.col("m.label").alias("most"))
    rows = lists.join(largest, "key").join(loads, "node").select("key", "most", F.struct("node", "n", "place", "label", "loads").alias("a"))
    few, every = rows.filter("a.label != most"), rows.select(F.col("key").alias("_key"), F.col("a").alias("b"))
    once = F.expr("a.label != b.label and (b.label = most or a.node < b.node)")
    # what both may share at most, part by part
    most = F.expr("aggregate(zip_with(a.loads, b.loads, (x, y) -> least(x, y)), 0, (s, x) -> s + x)")
    enough = (num + den) * most >= num * (F.col("a.n") + F.col("b.n"))
    joined = few.join(every, (F.col("key") == F.col("_key")) & once & _possible("a", "b", num, den) & enough)
    return joined.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def jaccard_components(docs: DataFrame, shingle_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, component_id) of every row: its set's
    size and digest, and the smallest doc_id that links reach."""
    spark = ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    bits = _shard_bits(texts)
    blocks = block_count(texts, "text", BLOCK_BYTES)
    # blocks are part of the rows from here on, so that both passes see the same ones
    rows = staged(spark, texts.withColumn("block", row_block(blocks, "doc_id", "text_hash")), "texts")
    rarities = staged(spark, frequencies(rows, shingle_words, bits, blocks), "rarities")
    release(spark)
    signed = staged(spark, prefixes(rows, rarities, shingle_words, num, den, blocks), "signed")
    release(spark)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")
    classes = staged(spark, signed.filter("node is not null").groupBy("node").agg(least), "classes")
    # a class's rows are alike in all that follows
    first = [F.first(c).alias(c) for c in ("grp", "n_shingles", "keys", "places", "loads", "text")]
    members = staged(spark, signed.filter("grp is not null").groupBy("node").agg(*first).withColumnRenamed("n_shingles", "n"), "members")
    release(spark)

    # groups, posted where another group is
    groups = members.groupBy("grp").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("members"), *[F.first(c).alias(c) for c in ("n", "keys", "places")])
    posts = groups.select("grp", "rep", "n", F.explode(F.arrays_zip("keys", "places")).alias("p")).select("grp", "rep", "n", F.col("p.keys").alias("key"), F.col("p.places").alias("place"))
    shared = posts.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).filter("lo != hi").select("key")
    lists = staged(spark, posts.join(shared, "key"), "lists")
    several = groups.filter("members > 1").select("grp", "rep")
    inside = staged(spark, members.join(several, "grp").select("grp", "node", "rep", "n"), "inside")
    fetched = members.select("node", "text")
    release(spark)

    labels = members.select("node", F.col("node").alias("label")).limit(0)

    def named(df: DataFrame, node: str) -> DataFrame:
        """``df`` with the component of its column ``node`` and that one's size."""
        sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        known = labels.join(sizes, "label").select(F.col("node").alias(node), "label", "size")
        return df.join(known, node, "left").withColumn("label", F.coalesce("label", node)).withColumn("size", F.coalesce("size", F.lit(1)))

    joined = tried = None
    for turn in range(TURNS + 1):
        if turn < TURNS:
            pairs = head_pairs(named(lists, "rep"), turn, num, den)
            if turn == 0:
                pairs = pairs.union(inside.filter("node != rep").select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")))
        else:
            apart = named(members.select("node", "grp"), "node")
            by_member = lists.select("grp", "key", "place", "n").join(apart, "grp")
            # a group's members have their whole prefix in common, from its first place on
            own = inside.select("node", F.col("grp").alias("_g"), "n").join(apart, "node").select(F.xxhash64("_g").alias("key"), F.lit(0).alias("place"), "n", "node", "label", "size")
            pairs = other_pairs(by_member.select("key", "place", "n", "node", "label", "size").union(own), members.select("node", "loads"), num, den)
        fresh, made = staged_count(spark, pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs.distinct(), "pairs")
        release(spark)
        if not made:
            continue
        tried = fresh if tried is None else tried.unionByName(fresh)
        links, found = staged_count(spark, confirmed(fresh, fetched, shingle_words, num, den), "links")
        release(spark)
        if found:
            labels = joined = extended(spark, joined, links)
            release(spark)
    by = F.min(F.struct(F.col("least.none").alias("none"), F.col("least.doc_id").alias("doc_id"))).alias("m")
    label = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = label.groupBy("label").agg(by).select("label", F.col("m.doc_id").alias("component_id"))
    of = label.join(heads, "label").select("node", "component_id")
    return signed.select("doc_id", "text_hash", "n_shingles", "node").join(of, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
                               WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
    FROM w)),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM pr JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d)
SELECT n.doc_id, n.n AS n_shingles, c AS component_id
FROM n JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) ON d = n.doc_id
"""
