"""Exact substring deduplication with a logarithmic family of suffix arrays.

A byte is removed if it lies in a ``SPAN``-byte string that also starts
earlier (smaller doc_id, or earlier in the same document).

Sampled suffixes: every ``SPAN``-byte window is filed under its minimiser, the
``SEED`` bytes inside it with the least hash. Windows that follow each other
under one minimiser form one region; a region is the stretch of text around
one sampled suffix, and equal windows always meet under an equal seed. So one
suffix in about 39 is enough, and no match of ``SPAN`` bytes is missed. The
suffixes of a batch, in the order of (fingerprint of the seed, fingerprint of
the region), are its suffix array; the fingerprints stand for the bytes, which
keeps rows short and gives the same neighbours.

Family: batches arrive in doc_id order. The array of a new batch is
merge-scanned with the existing levels: equal regions are neighbours, and all
but the first are long matches as a whole. Levels of the batch's own rank are
merged with it in the same pass and move up a rank (1, 2, 4 ...), other levels
are only scanned. A level holds the first place of each region.

Regions that share a seed but differ (at the edges of a match) are compared
window by window, once, on their texts: the regions of a seed meet in one
task. A seed with very many of them sends each window as a row of its own
instead, which Spark ranks.

Skew: a task reports a region it has seen before in the same Arrow batch as a
match at once, under a key of its own, so a passage in a third of all
documents sends one row per batch to the task of its seed.

Defined results: null text has no bytes; a null doc_id sorts first; equal rows
are one document and get equal results; rows that share a doc_id but not the
text are ordered by their hash; extra columns are kept by ``remove_repeats``;
an empty table gives no rows. Long texts are handled in segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import block_count, block_of, drop_held, release, ship, staged, table, unwrapped

SPAN = 100
SEED = 24
#: Distinct regions of one seed from which they are compared window by window
#: as rows, so that no task holds them together.
MANY_REGIONS = 2000
BLOCK_BYTES = 8 << 20
#: Shares of the documents in the batches of ``remove_repeats``: two equal ones,
#: whose levels merge, and the rest. Every row is in one shuffle as part of its
#: batch, and the rows of the small levels are in one or two more.
BATCHES = (0.125, 0.125, 0.75)
#: Text handled at once in a task; a buffer of two segments has fewer places
#: than ``_PLACE_BITS`` bits tell apart.
SEGMENT = 1 << 18
_PLACE_BITS = 20

_RANDOM = np.random.RandomState(20240102)
_LETTER = _RANDOM.randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = _U(base)
    return np.cumprod(out)


_POWER: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWER or len(_POWER[0]) < n:
        _POWER[:] = [_powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)]
    return _POWER[0], _POWER[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Hashed:
    """Fingerprints of all substrings of a buffer."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        power, self.inverse = _tables(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LETTER[raw] * power[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, n) -> np.ndarray:
        return _mix((self.sums[start + n] - self.sums[start]) * self.inverse[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``width`` neighbours. Values are
    compared by their upper bits; the lower ones hold the place."""
    low = _U((1 << _PLACE_BITS) - 1)
    least, size = (values & ~low) | np.arange(len(values), dtype=np.uint64), 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return (least & low).astype(np.int64)


def regions(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text index, start, length, seed fingerprint, region fingerprint) of the
    regions of every text; texts are laid into one buffer."""
    data = b"".join(texts)
    if len(data) < SPAN:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashed = Hashed(data)
    seeds = _mix((hashed.sums[SEED:] - hashed.sums[:-SEED]) * hashed.inverse[: len(data) - SEED + 1])
    least = _least(seeds, SPAN - SEED + 1)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    inside = np.zeros(len(data) + 1, np.int8)
    long = ends - starts >= SPAN
    inside[starts[long]] += 1
    inside[ends[long] - SPAN + 1] -= 1
    window = np.flatnonzero(np.cumsum(inside[: len(least)], dtype=np.int8))
    if not len(window):
        return regions([])
    seed = least[window]
    cut = np.flatnonzero((seed[1:] != seed[:-1]) | (window[1:] != window[:-1] + 1))
    first, last = window[np.concatenate(([0], cut + 1))], window[np.concatenate((cut, [len(window) - 1]))]
    at = seed[np.concatenate(([0], cut + 1))]
    n = last - first + SPAN
    shape = ((at - first) * 4096 + n).astype(np.uint64)
    region = _mix(hashed.of(first, n) ^ _mix(shape))
    owner = np.searchsorted(ends, first, "right")
    return owner, first - starts[owner], n, seeds[at], region


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of about a segment; long ones cut into segments that
    overlap, so that every window is in exactly one."""
    who, base, part, size = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - SPAN + 1), SEGMENT):
            piece = text if len(text) <= SEGMENT else text[at : at + SEGMENT + SPAN - 1]
            who, base, part, size = [*who, k], [*base, at], [*part, piece], size + len(piece)
            if size >= SEGMENT:
                yield who, base, part
                who, base, part, size = [], [], [], 0
            if len(text) <= SEGMENT:
                break
    if part:
        yield who, base, part


def _first_of(key: np.ndarray, d: np.ndarray, sub: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every row whether a row with its key comes earlier (d, sub, at)."""
    order = np.lexsort((at, sub, d, key))
    k, dd, ss, aa = key[order], d[order], sub[order], at[order]
    again = np.zeros(len(key), bool)
    same = (k[1:] == k[:-1]) & ((dd[1:] != dd[:-1]) | (ss[1:] != ss[:-1]) | (aa[1:] != aa[:-1]))
    # equal rows (d, sub, at) are one place: they share the answer of the first
    tie = np.concatenate(([False], (k[1:] == k[:-1]) & ~same))
    again[order[1:][same]] = True
    for i in np.flatnonzero(tie).tolist():
        again[order[i]] = again[order[i - 1]]
    return again


def suffixes(docs: DataFrame) -> DataFrame:
    """The rows (seed, region, d, sub, at) of the documents' suffix array, unsorted.

    ``at`` packs start, length and, in the lowest bit, whether the same region
    was met earlier in the same Arrow batch; such a row is already a match and
    has a seed of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for batch in batches:
            ids = batch.column("_d").to_numpy()
            sub = batch.column("_sub").to_numpy()
            texts = [t.as_py() or b"" for t in batch.column("_text")]
            parts = []
            for who, base, part in _pieces(texts):
                owner, start, n, seed, region = regions(part)
                doc = np.array(who)[owner]
                parts.append((seed, region, ids[doc], sub[doc], _pack(start + np.array(base)[owner], n)))
            if not parts:
                continue
            seed, region, d, s, at = (np.concatenate(x) for x in zip(*parts))
            again = _first_of(_mix(seed) ^ region, d, s, at)
            seed = np.where(again, _mix(d.astype(np.uint64) * _U(_BASE) ^ _mix(s.view(np.uint64)) ^ at.astype(np.uint64)), seed)
            columns = [pa.array(seed.view(np.int64)), pa.array(region.view(np.int64)), pa.array(d), pa.array(s), pa.array(at | again)]
            yield from pa.Table.from_arrays(columns, ["seed", "region", "d", "sub", "at"]).to_batches(50_000)

    return docs.select("_d", "_sub", "_text").mapInArrow(run, "seed bigint, region bigint, d bigint, sub bigint, at bigint")


def _pack(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 12) | (n.astype(np.int64) << 1)


class Family:
    """Levels by rank; ``add`` scans a batch against all of them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels = spark, {}
        self.merges = 0

    def add(self, batch: DataFrame, keep: bool = True) -> DataFrame:
        """(seed, d, sub, at, whole, many) of the batch's matches: regions that occur
        earlier (``whole``) and the first places of regions that share a seed
        with another one (not ``whole``; ``many``: with very many).
        ``keep``: the batch becomes a level."""
        rank, merging = 0, []
        while keep and rank in self.levels:
            merging.append(self.levels.pop(rank))
            rank += 1
            self.merges += 1
        rows = batch.withColumn("src", F.lit(0))
        for df in merging:
            rows = rows.unionByName(df.withColumn("src", F.lit(1)))
        for df in self.levels.values():
            rows = rows.unionByName(df.withColumn("src", F.lit(2)))
        of_seed = Window.partitionBy("seed")
        of_region = Window.partitionBy("seed", "region").orderBy("d", "sub", "at")
        scanned = (
            rows.repartition("seed")
            .withColumn("first", F.rank().over(of_region) == 1)
            .withColumn("mixed", (F.min("region").over(of_seed) != F.max("region").over(of_seed)) & (F.min("src").over(of_seed) == 0))
            .withColumn("many", F.sum(F.col("first").cast("int")).over(of_seed) > MANY_REGIONS)
            .withColumn("done", F.expr("at & 1 = 1"))
        )
        match = F.col("done") | ~F.col("first")
        wanted = (match & (F.col("src") == 0)) | (F.col("mixed") & F.col("first"))
        if keep:
            wanted = wanted | (F.col("src") < 2)
        scanned = staged(self.spark, scanned.filter(wanted).select("seed", "region", "d", "sub", "at", "src", "mixed", "many", match.alias("match")), "level")
        if keep:
            self.levels[rank] = scanned.filter("src < 2 and not match").select("seed", "region", "d", "sub", "at")
        return scanned.filter("(match and src = 0) or (mixed and not match)").select("seed", "d", "sub", "at", F.col("match").alias("whole"), "many")


_PLACES = "seed bigint, d bigint, sub bigint, at bigint, region binary"


def _region_texts(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """(seed, d, sub, at, region) with the text of every region of ``edges``; for a
    seed with many regions a row for each window, under a key of its own and
    without a text."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts: list[tuple] = []
        seed, d, sub, at, many = (right[c].to_numpy() for c in ("seed", "d", "sub", "at", "many"))
        places: dict[tuple[int, int], list[int]] = {}
        for k, x in enumerate(zip(d.tolist(), sub.tolist())):
            places.setdefault(x, []).append(k)
        for i, x in enumerate(zip(left["_d"].to_pylist(), left["_sub"].to_pylist()) if places else ()):
            if (mine := places.pop(x, None)) is None:
                continue
            data = left["_text"][i].as_py()
            for k in mine:
                start, n = (int(at[k]) >> 12) & ((1 << 38) - 1), (int(at[k]) >> 1) & 2047
                region = data[start : start + n]
                if not many[k]:
                    parts.append(([int(seed[k])], [x[0]], [x[1]], [int(at[k])], [region]))
                    continue
                j = np.arange(n - SPAN + 1)
                own = _mix(Hashed(region).of(j, SPAN) ^ _mix(seed[k : k + 1].view(np.uint64)))
                parts.append((own.view(np.int64).tolist(), [x[0]] * len(j), [x[1]] * len(j), _pack(start + j, np.full(len(j), SPAN)).tolist(), [None] * len(j)))
        columns = [[v for p in parts for v in p[c]] for c in range(5)]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("seed", "d", "sub", "at", "region"), columns, (*[pa.int64()] * 4, pa.binary()))})

    return blocks.groupBy("_block").cogroup(edges.groupBy("_block")).applyInArrow(run, _PLACES)


def _repeated_windows(texts: DataFrame) -> DataFrame:
    """(d, sub, at) of the stretches of regions whose windows occur earlier in another
    region of their seed."""

    def compared(rows: pa.Table) -> pa.RecordBatch:
        seed, d, sub, at = (rows[c].to_numpy() for c in ("seed", "d", "sub", "at"))
        data = [x.as_py() for x in rows["region"]]
        sizes = np.array([len(x) for x in data])
        count = sizes - SPAN + 1
        row = np.repeat(np.arange(len(data)), count)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        place = (np.cumsum(sizes) - sizes)[row] + inside
        window = Hashed(b"".join(data)).of(place, SPAN) ^ _mix(seed.view(np.uint64))[row]
        start = (at >> 12) & ((1 << 38) - 1)
        again = np.flatnonzero(_first_of(window, d[row], sub[row], _pack(start[row] + inside, np.full(len(row), SPAN))))
        # windows next to each other are one stretch
        cut = np.flatnonzero((row[again][1:] != row[again][:-1]) | (again[1:] != again[:-1] + 1)) + 1 if len(again) else np.empty(0, np.int64)
        first = again[np.concatenate((np.zeros(min(1, len(again)), np.int64), cut))]
        last = again[np.concatenate((cut - 1, np.full(min(1, len(again)), len(again) - 1)))]
        r = row[first]
        return pa.RecordBatch.from_arrays([pa.array(d[r]), pa.array(sub[r]), pa.array(_pack(start[r] + inside[first], last - first + SPAN))], ["d", "sub", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the seed that the batch before ended in, at most MANY_REGIONS rows
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            seeds = rows["seed"].to_numpy()
            cut = int(np.searchsorted(seeds, seeds[-1])) if len(seeds) else 0
            held = rows.slice(cut).combine_chunks()
            if cut:
                yield compared(rows.slice(0, cut).combine_chunks())
        if held is not None and len(held):
            yield compared(held)

    whole = texts.filter("region is not null").repartition("seed").sortWithinPartitions("seed")
    alone = texts.filter("region is null").withColumn("r", F.rank().over(Window.partitionBy("seed").orderBy("d", "sub", "at"))).filter("r > 1")
    return whole.mapInArrow(run, "d bigint, sub bigint, at bigint").unionByName(alone.select("d", "sub", "at"))


def united(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of spans."""
    out: list[list[int]] = []
    for s, e in sorted(zip(start.tolist(), end.tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _numbered(docs: DataFrame) -> DataFrame:
    """Adds ``_d`` (doc_id, null first) and ``_sub``, the hash of the text, which
    is 0 but for rows that share their doc_id with another text."""
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    docs = docs.withColumn("_d", order).withColumn("_hash", F.xxhash64("_text"))
    clashing = docs.groupBy("_d").agg(F.min("_hash").alias("lo"), F.max("_hash").alias("hi")).filter("lo != hi").select("_d")
    if clashing.isEmpty():
        return docs.drop("_hash").withColumn("_sub", F.lit(0).cast("long"))
    docs = docs.join(clashing.withColumn("_clash", F.lit(True)), "_d", "left")
    return docs.withColumn("_sub", F.when(F.col("_clash"), F.col("_hash")).otherwise(F.lit(0).cast("long"))).drop("_hash", "_clash")


def _block(d: str, sub: str, blocks: int) -> Column:
    """Texts of one doc_id spread over the blocks."""
    return block_of(F.xxhash64(d, sub), blocks)


def apply_spans(docs: DataFrame, report: Callable[[pa.Table, list], pa.Table], schema: T.StructType) -> DataFrame:
    """``report(rows, spans)`` for the rows (doc_id, _text, ...) of each block,
    ``spans`` holding the removed runs [start, end) of every row."""
    spark = ship(docs.sparkSession)
    blocks = block_count(docs, "_text", BLOCK_BYTES)
    docs = _numbered(docs)
    shares, done = [0.0], 0.0
    for share in BATCHES[:-1]:
        done += share
        shares.append(done)
    bounds = docs.select(F.percentile_approx("_d", [float(x) for x in shares[1:]], 10_000)).first()[0] or [0] * (len(shares) - 1)
    family, matches = Family(spark), None
    for i in range(len(shares)):
        part = docs
        if i:
            part = part.filter(F.col("_d") > bounds[i - 1])
        if i < len(shares) - 1:
            part = part.filter(F.col("_d") <= bounds[i])
        found = family.add(suffixes(part), keep=i < len(shares) - 1)
        release(spark)
        matches = found if matches is None else matches.unionByName(found)
    placed = docs.withColumn("_block", _block("_d", "_sub", blocks)).repartition("_block")
    edges = matches.filter("not whole").groupBy("seed", "d", "sub", "at").agg(F.max("many").alias("many")).withColumn("_block", _block("d", "sub", blocks))
    again = _repeated_windows(staged(spark, _region_texts(placed, edges), "regions"))
    release(spark)
    spans = matches.filter("whole").select("d", "sub", "at").unionByName(again).withColumn("_block", _block("d", "sub", blocks))
    names = [f.name for f in schema.fields]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        d, sub, at = (right[c].to_numpy() for c in ("d", "sub", "at"))
        start, n = (at >> 12) & ((1 << 38) - 1), (at >> 1) & 2047
        order = np.lexsort((start, sub, d))
        d, sub, start, n = d[order], sub[order], start[order], n[order]
        cut = np.flatnonzero((d[1:] != d[:-1]) | (sub[1:] != sub[:-1])) + 1 if len(d) else np.empty(0, np.int64)
        lows, highs = np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(d)])).tolist()
        mine = {(int(d[a]), int(sub[a])): (a, b) for a, b in zip(lows, highs) if b > a}
        found = []
        for x in zip(left["_d"].to_pylist(), left["_sub"].to_pylist()):
            a, b = mine.get(x, (0, 0))
            found.append(united(start[a:b], start[a:b] + n[a:b]))
        return report(left, found).select(names)

    return placed.groupBy("_block").cogroup(spans.groupBy("_block")).applyInArrow(run, schema)


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in runs for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns and the repeated bytes cut out of ``text``; what
    a cut leaves of a character goes with it."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("_row"), "doc_id", F.col("text").cast("binary").alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("text", T.StringType())])

    def report(part: pa.Table, spans: list) -> pa.Table:
        texts = [
            _kept(t.as_py(), r).decode("utf-8", "ignore") if r else None if not t.is_valid else t.as_py().decode("utf-8", "replace")
            for t, r in zip(part["_text"], spans)
        ]
        return pa.table({"_row": part["_row"], "text": pa.array(texts, pa.string())})

    return unwrapped(apply_spans(rows, report, schema), docs, text=F.col("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256", T.StringType())]
    )

    def report(rows: pa.Table, spans: list) -> pa.Table:
        texts = [t.as_py() or b"" for t in rows["_text"]]
        return pa.table(
            {
                "doc_id": rows["doc_id"].cast(pa.int64()),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array([sum(b - a for a, b in r) for r in spans], pa.int64()),
                "n_spans": pa.array([len(r) for r in spans], pa.int64()),
                "kept_sha256": [hashlib.sha256(_kept(t, r)).hexdigest() for t, r in zip(texts, spans)],
            }
        )

    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("_text"))
    return apply_spans(docs, report, schema)
