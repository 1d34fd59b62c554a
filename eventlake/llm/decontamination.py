"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items are put into one suffix automaton over words; the
words of a document are streamed through it, which tracks the longest match
that ends at each word. Matches of at least ``window`` words (or of a whole
item that has fewer) are hits.

``scan`` reports hit words, hit spans and items per document; ``decontaminate``
removes documents whose hits reach the coverage limit and, if asked, cuts
spans beyond a length limit out of the others.

Defined results: a null or empty text has no words and no hits; an item
without words has no window; equal item_ids count once, a null item_id is
named ``null``; repeated rows are judged row by row; extra columns are
ignored by ``scan`` and kept by ``decontaminate``; without items or documents
the result has no hits or no rows. A very long text is one row of one task, whose
words take about ten times its bytes; a very long item is cut into pieces that
overlap by a window less a word.

Scale: documents are not shuffled with one block. Tasks pack the items' pieces
into blocks of at most ``block_bytes`` of words, build an automaton of each (at
most a state a byte, in flat arrays) and write it to a table. The driver fetches
one block at a time, broadcasts it for a pass over the documents and lets go of
it; the hits of several passes are united by text.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import block_count, drop_held, held, ship, staged, table, unwrapped

WINDOW = 13
#: A document is contaminated if hits are at least one word in so many.
COVERAGE = 20
BLOCK_BYTES = 4 << 20

#: Everything in ASCII that is no digit or letter separates; A-Z becomes a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, in flat arrays.

    ``items`` are (name, words). ``scan`` gives the covered word positions of
    a sequence and the names of the items with a window in it. A state has its
    edges side by side, ordered by word; the first state's edges are all words.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        ids: dict[bytes, int] = {}
        kept = [(name, np.array([ids.setdefault(w, len(ids)) for w in words], np.int32)) for name, words in items if words]
        states = _States()
        for _, seq in kept:
            last = 0
            for c in seq.tolist():
                last = states.extend(last, c)
        link, size = np.frombuffer(states.link, np.int32), np.frombuffer(states.size, np.int32)
        up, words_in, by_size = memoryview(link), memoryview(size), np.argsort(size, kind="stable").astype(np.int32)
        # the state of a state's last ``window`` words, from short states to long ones
        at_window = np.full(len(link), -1, np.int32)
        for s in memoryview(by_size[np.searchsorted(size[by_size], window) :]):
            at_window[s] = s if words_in[up[s]] < window else at_window[up[s]]
        holds, short = [np.empty((0, 2), np.int64)], []
        for item, (_, seq) in enumerate(kept):
            passed, state = np.empty(len(seq), np.int32), 0
            for k, c in enumerate(seq.tolist()):
                state = passed[k] = states.to(state, c)
            if len(seq) >= window:
                at = np.unique(at_window[passed[window - 1 :]]).astype(np.int64)
                holds.append(np.stack([at, np.full(len(at), item)], 1))
            else:
                while words_in[up[state]] >= len(seq):
                    state = up[state]
                short.append((state, item, len(seq)))
        held_by = np.concatenate(holds)
        held_by = held_by[np.argsort(held_by[:, 0], kind="stable")].astype(np.int32)
        whole = np.array(sorted(short), np.int32).reshape(-1, 3)
        near = np.empty(0, np.int32)
        if len(whole):
            near = np.zeros(len(link), np.int32)
            near[whole[:, 0]] = whole[:, 0]
            for s in memoryview(by_size[1:]):
                if not near[s]:
                    near[s] = near[up[s]]
        start, edge_word, edge_to = states.edges()
        pairs = np.concatenate([_pairs(seq.astype(np.int64)) for _, seq in kept] or [np.empty(0, np.int64)])
        self._open(
            {
                "window": window, "names": [name for name, _ in kept], "words": b" ".join(ids),
                "link": link, "size": size, "start": start, "edge_word": edge_word, "edge_to": edge_to, "at_window": at_window,
                "near": near, "pairs": np.unique(pairs), "hold_state": held_by[:, 0], "hold_item": held_by[:, 1],
                "short_state": whole[:, 0], "short_item": whole[:, 1], "short_words": whole[:, 2],
            }
        )

    @classmethod
    def load(cls, row: dict) -> Automaton:
        """From what ``row`` gives."""
        new = cls.__new__(cls)
        new._open(row | {k: np.frombuffer(row[k], np.int64 if k == "pairs" else np.int32) for k in _ARRAYS})
        return new

    def row(self) -> dict:
        return self.parts | {k: self.parts[k].tobytes() for k in _ARRAYS}

    def _open(self, parts: dict) -> None:
        self.parts, self.window, self.names, self.pairs = parts, parts["window"], parts["names"], parts["pairs"]
        self.ids = {w: i for i, w in enumerate(parts["words"].split())}
        self.holds = parts["hold_state"], parts["hold_item"]
        self.short: dict[int, list[tuple[int, int]]] = {}
        for state, item, n in zip(*(parts[k].tolist() for k in ("short_state", "short_item", "short_words"))):
            self.short.setdefault(state, []).append((item, n))
        self.least = min([self.window, *parts["short_words"].tolist()])

    def _stream(self, ids: list[int], base: int, hit: np.ndarray, windows: set[int], found: set[int]) -> None:
        start, words, to, link, size, at_window, near = (memoryview(self.parts[k]) for k in _STREAMED)
        state = length = 0
        for i, c in enumerate(ids):
            while state:
                k = bisect_left(words, c, start[state], start[state + 1])
                if k < start[state + 1] and words[k] == c:
                    break
                state = link[state]
                length = size[state]
            else:
                k = c
            state, length = to[k], length + 1
            if length >= self.window:
                hit[base + i - self.window + 1 : base + i + 1] = True
                windows.add(at_window[state])
            if self.short and length >= self.least:
                at = near[state]
                while at:
                    for item, n in self.short[at]:
                        if n <= length:
                            hit[base + i - n + 1 : base + i + 1] = True
                            found.add(item)
                    at = near[link[at]]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        hit, windows, found = np.zeros(len(words), bool), set(), set()
        if len(words) >= self.least and self.ids:
            get = self.ids.get
            ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
            # a match lies inside a stretch of known words, each of which follows the one before somewhere
            joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
            joined[joined] = _among(_pairs(ids)[joined], self.pairs)
            cuts = np.flatnonzero(~joined) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(ids)]))
            long = (ends - starts >= self.least) & (ids[starts] >= 0)
            for a, b in zip(starts[long].tolist(), ends[long].tolist()):
                self._stream(ids[a:b].tolist(), a, hit, windows, found)
        if windows:
            state, item = self.holds
            at = np.fromiter(windows, np.int32, len(windows))
            for lo, hi in zip(np.searchsorted(state, at, "left").tolist(), np.searchsorted(state, at, "right").tolist()):
                found.update(item[lo:hi].tolist())
        return hit, {self.names[i] for i in found}


def _pairs(ids: np.ndarray) -> np.ndarray:
    return (ids[:-1] << 32) | ids[1:]


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the ordered ``known``."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


class _States:
    """The automaton while it grows: one edge of a state in arrays, further ones
    in a dictionary that only branching states have."""

    def __init__(self):
        self.link, self.size = array("i", [-1]), array("i", [0])
        self.word, self.next = array("i", [-1]), array("i", [-1])
        self.more: dict[int, dict[int, int]] = {0: {}}

    def to(self, state: int, c: int) -> int:
        """The state after ``c``, -1 without."""
        if self.word[state] == c:
            return self.next[state]
        more = self.more.get(state)
        return more.get(c, -1) if more else -1

    def _set(self, state: int, c: int, to: int) -> None:
        if self.word[state] == c or self.word[state] < 0 and state:
            self.word[state], self.next[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def _new(self, size: int, link: int, like: int | None = None) -> int:
        new = len(self.link)
        self.link.append(link)
        self.size.append(size)
        self.word.append(-1 if like is None else self.word[like])
        self.next.append(-1 if like is None else self.next[like])
        if like in self.more:
            self.more[new] = dict(self.more[like])
        return new

    def extend(self, last: int, c: int) -> int:
        q = self.to(last, c)
        if q >= 0:
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, c, q)
        cur, p = self._new(self.size[last] + 1, 0), last
        while p >= 0 and (q := self.to(p, c)) < 0:
            self._set(p, c, cur)
            p = self.link[p]
        if p >= 0:
            self.link[cur] = q if self.size[q] == self.size[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._new(self.size[p] + 1, self.link[q], like=q)
        self.link[q] = new
        while p >= 0 and self.to(p, c) == q:
            self._set(p, c, new)
            p = self.link[p]
        return new

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, words, to): the edges of state s from start[s] to start[s + 1]."""
        word, to = np.frombuffer(self.word, np.int32), np.frombuffer(self.next, np.int32)
        first = np.flatnonzero(word >= 0)
        sizes = [len(x) for x in self.more.values()]
        n = sum(sizes)
        state = np.concatenate([first, np.repeat(np.fromiter(self.more, np.int64, len(sizes)), sizes)])
        word = np.concatenate([word[first], np.fromiter((c for x in self.more.values() for c in x), np.int32, n)])
        to = np.concatenate([to[first], np.fromiter((t for x in self.more.values() for t in x.values()), np.int32, n)])
        order = np.lexsort((word, state))
        start = np.concatenate(([0], np.cumsum(np.bincount(state, minlength=len(self.link))))).astype(np.int32)
        return start, word[order], to[order]


_STREAMED = ("start", "edge_word", "edge_to", "link", "size", "at_window", "near")
_ARRAYS = (*_STREAMED, "pairs", "hold_state", "hold_item", "short_state", "short_item", "short_words")
_BLOCK = "block string, window int, names array<string>, words binary, " + ", ".join(f"{k} binary" for k in _ARRAYS)
_BLOCK_ARROW = pa.schema(
    [("block", pa.string()), ("window", pa.int32()), ("names", pa.list_(pa.string())), ("words", pa.binary())] + [(k, pa.binary()) for k in _ARRAYS]
)


def runs_of(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).tolist()
    return list(zip(edges[::2], edges[1::2]))


def pieces_of(words: list[bytes], window: int, most: int) -> Iterator[list[bytes]]:
    """Parts of at most ``most`` words (``window`` at least) that have all windows
    of an item; a part of a longer item has a whole window."""
    most = max(most, window)
    for at in range(0, max(1, len(words) - window + 1), most - window + 1):
        yield words[at : at + most]


def automata(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, ...): an automaton a row, each of at most ``block_bytes`` of words,
    built in a task. The items are cut into pieces, equal ones are one, and what
    a task gets is packed into blocks."""
    spark = ship(benchmark.sparkSession)
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.col("text").cast("binary").alias("text")
    ).filter("text is not null")
    most = max(1, block_bytes // 64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text")):
                if words := words_of(text.as_py()):
                    pieces = [b" ".join(x) for x in pieces_of(words, window, most)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(pieces)), pa.array(pieces, pa.binary())], ["name", "piece"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        part = TaskContext.get().partitionId()

        def packed() -> Iterator[list[tuple[str, list[bytes]]]]:
            block, size = [], 0
            for batch in batches:
                for name, piece in zip(batch.column("name").to_pylist(), batch.column("piece").to_pylist()):
                    if block and size + len(piece) > block_bytes:
                        yield block
                        block, size = [], 0
                    block.append((name, piece.split()))
                    size += len(piece) + 1
            if block:
                yield block

        for k, block in enumerate(packed()):
            yield pa.RecordBatch.from_pylist([{"block": f"{part}-{k}"} | Automaton(block, window).row()], _BLOCK_ARROW)

    pieces = staged(spark, rows.mapInArrow(cut, "name string, piece binary").distinct(), "pieces")
    # tasks are dealt a little less than a block, so that few of them make a second one
    parts = block_count(pieces, "piece", block_bytes * 4 // 5)
    return staged(spark, pieces.repartition(parts).mapInArrow(build, _BLOCK), "automata")


def each_automaton(benchmark: DataFrame, window: int, block_bytes: int) -> list[Callable[[], _Sent]]:
    """One way to send each block; the driver has one of them at a time."""
    spark = benchmark.sparkSession
    built = automata(benchmark, window, block_bytes)
    names = sorted(r["block"] for r in built.select("block").collect())

    def send(name: str) -> Callable[[], _Sent]:
        def fetch() -> _Sent:
            row = built.filter(F.col("block") == name).drop("block").first().asDict()
            return _Sent(spark, {k: bytes(v) if isinstance(v, bytearray) else v for k, v in row.items()})

        return fetch

    return [send(name) for name in names] or [lambda: _Sent(spark, Automaton([], window).row())]


class _Sent:
    """A broadcast automaton with the id its copies in the executors share; an
    executor process opens it once."""

    def __init__(self, spark: SparkSession, row: dict):
        self.sent = spark.sparkContext.broadcast(row)
        self.id = self.sent._jbroadcast.id()

    def __getstate__(self):
        return (self.sent, self.id)

    def __setstate__(self, x):
        self.sent, self.id = x

    def automaton(self) -> Automaton:
        return held(("automaton", self.id), lambda: Automaton.load(self.sent.value))


_HITS = "n_words bigint, runs array<struct<a: bigint, b: bigint>>, items array<string>"


def _scan_block(rows: DataFrame, sent: _Sent, only_hits: bool = False) -> DataFrame:
    """The columns of ``rows`` but ``_text``, with what the block finds in it."""
    keep = [c for c in rows.columns if c != "_text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = sent.automaton()
        for batch in batches:
            counts, runs, items = [], [], []
            for text in batch.column("_text"):
                words = words_of(text.as_py())
                hit, found = automaton.scan(words)
                counts.append(len(words))
                runs.append([{"a": a, "b": b} for a, b in runs_of(hit)])
                items.append(sorted(found))
            span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            out = pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(counts, pa.int64()), pa.array(runs, span), pa.array(items, pa.list_(pa.string()))],
                [*keep, "n_words", "runs", "items"],
            )
            yield out.filter(pa.array([bool(r) for r in runs], pa.bool_())) if only_hits else out

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(scan, f"{kept}, {_HITS}")


def _passes(rows: DataFrame, sends: list[Callable[[], _Sent]], all_rows: bool) -> DataFrame:
    """What each block finds in ``rows``, one pass and one broadcast after the other;
    with ``all_rows`` the first pass (``_part`` 0) has rows without hits, too."""
    spark, every = rows.sparkSession, None
    for i, send in enumerate(sends):
        sent = send()
        part = staged(spark, _scan_block(rows, sent, only_hits=bool(i) or not all_rows), "hits").withColumn("_part", F.lit(i))
        sent.sent.destroy()
        every = part if every is None else every.unionByName(part)
    return every


#: Runs of several blocks put together: overlapping and adjacent ones are one.
_UNITED = (
    "aggregate(sort_array(all_runs), cast(array() as array<struct<a: bigint, b: bigint>>), (acc, r) -> "
    "if(size(acc) > 0 and element_at(acc, -1).b >= r.a, concat(slice(acc, 1, size(acc) - 1), "
    "array(struct(element_at(acc, -1).a as a, greatest(element_at(acc, -1).b, r.b) as b))), "
    "concat(acc, array(struct(r.a as a, r.b as b)))))"
)
_COVERED = "aggregate(runs, 0L, (s, r) -> s + r.b - r.a)"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, runs, items) per row of (doc_id, text): ``runs``
    are the maximal runs [a, b) of hit words, ``items`` the sorted item names."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    sends = each_automaton(benchmark, window, block_bytes)
    if len(sends) == 1:
        hits = _scan_block(rows, sends[0]())
    else:
        every = _passes(rows.withColumn("_key", F.sha2("_text", 256)), sends, all_rows=True)
        # equal rows have equal hits: they are counted, united once and told apart again
        united = every.groupBy("_key", "doc_id", "n_words").agg(
            F.sum(F.when(F.col("_part") == 0, 1).otherwise(0)).alias("copies"),
            F.flatten(F.collect_set("runs")).alias("all_runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        merged = united.withColumn("runs", F.expr(_UNITED))
        hits = merged.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)"))).select("doc_id", "n_words", "runs", "items")
    return hits.withColumn("n_hit", F.expr(_COVERED))


def contaminated(coverage: int = COVERAGE):
    return (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))


def _cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``runs`` (and what stands between them)."""
    at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    parts, done = [], 0
    for a, b in runs:
        parts.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*parts, text[done:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: int | None = COVERAGE,
    max_span: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with all columns: documents with one hit word in ``coverage`` or
    more are removed; in the others, runs of at least ``max_span`` hit words
    are cut out of the text. None switches a limit off."""
    sends = each_automaton(benchmark, window, block_bytes)

    def cut(batch: pa.RecordBatch, runs: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        long = [[r for r in x if r[1] - r[0] >= max_span] for x in runs]
        texts = [_cut(t.encode(), r).decode("utf-8", "replace") if r else t for t, r in zip(batch.column("text").to_pylist(), long)]
        at = batch.schema.get_field_index("text")
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    if len(sends) == 1:
        sent = sends[0]()

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = sent.automaton()
            for batch in batches:
                hits = [automaton.scan(words_of(t.encode() if t else None))[0] for t in batch.column("text").to_pylist()]
                keep = [not (coverage and h.any() and coverage * int(h.sum()) >= len(h)) for h in hits]
                if max_span:
                    batch = cut(batch, [runs_of(h) if k else [] for h, k in zip(hits, keep)])
                yield batch.filter(pa.array(keep, pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)

    # hits depend on the text alone: found once a text, they are joined to its rows
    key = F.sha2(F.col("text").cast("binary"), 256).alias("_key")
    found = _passes(docs.select(key, F.col("text").cast("binary").alias("_text")), sends, all_rows=False)
    by_text = found.groupBy("_key", "n_words").agg(F.flatten(F.collect_set("runs")).alias("all_runs"))
    by_text = by_text.select("_key", "n_words", F.expr(_UNITED).alias("runs")).withColumn("n_hit", F.expr(_COVERED))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), key).join(by_text, "_key", "left")
    if coverage:
        rows = rows.filter(F.col("n_hit").isNull() | ~contaminated(coverage))
    if not max_span:
        return unwrapped(rows, docs)
    runs_name = "_" * (1 + max(map(len, docs.columns)))

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [[(r["a"], r["b"]) for r in x or ()] for x in batch.column(runs_name).to_pylist()]
            yield cut(batch.drop_columns([runs_name]), runs)

    wide = rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns], F.col("runs").alias(runs_name))
    return wide.mapInArrow(trim, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hit AS (SELECT r, item_id, i, n FROM dw JOIN win USING (n, g)),
per AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
it AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per USING (r) LEFT JOIN it USING (r)
"""
