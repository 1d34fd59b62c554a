"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes. Each gives an array of byte offsets at which
its tokens end. Where the tokens of both agree, the arrays are equal at a fixed
shift of the index: probes of doubling length compare stretches of both at the
current shift, the first probe that differs is halved down to the first
difference, and the whole stretch is jumped. There the side that lags moves on
token by token until both ends meet again; this irregular group sets the new
shift. The offsets at which both end cut the tokens into groups.

Texts of a batch are laid end to end, so one walk aligns them all. A pair of ids
is linked where its tokens share a group; a group of many tokens is counted by
its distinct ids, never pair by pair.

Corpus counts: documents are dealt to blocks by row. The distinct pairs of each
block are counted and joined with the sums over all blocks by pair, so that a
pair costs one row a block however many documents hold it; a block then looks up
its own pairs. Memory of a task is bounded by a block and its pairs (and by its
longest text, of which about 60 bytes are held a byte).

The byte-level vocabulary (``tokenizers`` JSON) and the piece model
(``sentencepiece``) are parameters, read on the driver and broadcast after a
check of their size. No token of either goes on over a blank that follows other
text, so what the libraries make of a blank and a word is checked against the
word's bytes and kept, up to a bound; texts with other blanks are encoded as a
whole.

Defined results: null and empty texts have no tokens and zeros, as have texts
that either side does not give back byte for byte (one with U+2581, say); names
of special tokens are plain text; repeated rows are rows each and count each;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import bpe
from eventlake.llm.common import block_count, drop_held, held, release, row_block, ship, staged, table, uncollected

PIECES = "piece_bpe_32k.model"
MAX_MODEL_BYTES = 64 << 20
#: Text of a block, and of what a task aligns at a time.
BLOCK_BYTES, GROUP_BYTES = 8 << 20, 1 << 20
CACHE_WORDS = 350_000
#: New words that are one text, and whose bytes are compared at once.
JOINED_WORDS, CHECKED_WORDS = 64, 512
#: Bytes of the first probe of two stretches.
PROBE = 32
#: Longer stretches without a blank are not kept.
CACHE_CHARS = 64
#: Groups of up to so many links are written out, larger ones counted by id.
SMALL = 64
_MARK = "▁"


def load(path: str) -> bytes:
    """A tokenizer's file, which all tasks get."""
    raw = Path(path).read_bytes()
    if len(raw) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: {len(raw)} bytes are more than a tokenizer may have")
    return raw


class Bytewise:
    """A byte-level vocabulary, and the bytes of its tokens."""

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(spec.decode())
        self.model.encode_special_tokens = True  # their names are plain text
        self.model.no_truncation()
        self.model.no_padding()
        letters, vocabulary = bpe._byte_letters(), self.model.get_vocab()
        self.token = [b""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            self.token[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.begins = np.array([t.startswith(b" ") for t in self.token])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids."""
        return [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


    def encode_words(self, spaced: list[str]) -> list[bytes]:
        """``encode`` of words with a blank before each, several as one text: the
        tokens that begin with a blank begin the words."""
        out = []
        groups = [spaced[at : at + JOINED_WORDS] for at in range(0, len(spaced), JOINED_WORDS)]
        for group, ids in zip(groups, self.encode(["".join(g) for g in groups])):
            edges = [*(4 * np.flatnonzero(self.begins[np.frombuffer(ids, "<u4")])).tolist(), len(ids)]
            out += [ids[a:b] for a, b in zip(edges, edges[1:])] if len(edges) == len(group) + 1 else self.encode(group)
        return out


class Pieces:
    """A piece model, and the bytes of its tokens."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token = [bytes([int(s[3:5], 16)]) if self.model.is_byte(i) else s.replace(_MARK, " ").encode() for i, s in enumerate(names)]
        # no piece goes on over a blank: words are encoded each on their own
        self.by_word = not any(_MARK in s.lstrip(_MARK) for s in names)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids; the model puts a blank before each text."""
        return [array("I", i).tobytes() for i in self.model.encode(texts, num_threads=1)]


def common_ends(ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in ``ea`` and ``eb`` of the ends that both have. Both arrays rise
    and have the same last end."""
    ea, eb = np.ascontiguousarray(ea, np.int64), np.ascontiguousarray(eb, np.int64)
    a, b, la, lb = ea.tobytes(), eb.tobytes(), ea.tolist(), eb.tolist()
    n = len(la)
    runs: list[int] = []  # start in a, start in b, length
    i = j = 0
    while i < n:
        x, y, step, most = 8 * i, 8 * j, PROBE, 8 * n  # in bytes
        while x < most and a[x : x + step] == b[y : y + step]:
            x += step
            y += step
            step *= 2
        while step > 8:  # the first difference is in the last probe
            step //= 2
            if a[x : x + step] == b[y : y + step]:
                x += step
                y += step
        run = min(x, most) // 8 - i
        runs += (i, j, run)
        i, j = i + run, j + run
        if i < n:
            x, y = la[i], lb[j]
            while x != y:
                if x < y:
                    i += 1
                    x = la[i]
                else:
                    j += 1
                    y = lb[j]
    starts, others, sizes = np.array(runs, np.int64).reshape(-1, 3).T
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return at, at + np.repeat(others - starts, sizes)


def linked(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of the links: group ``g`` holds the next ``p[g]`` ids of
    ``a`` and ``q[g]`` of ``b``. A pair is ``a << 32 | b``; it may come up more
    than once."""
    start_a, start_b = np.cumsum(p) - p, np.cumsum(q) - q
    small = p * q <= SMALL
    rows = np.flatnonzero(np.repeat(small, p))  # places in a
    group = np.repeat(np.arange(len(p)), p)[rows]
    width = q[group]
    first = np.cumsum(width) - width
    of = np.repeat(np.arange(len(rows)), width)
    right = start_b[group][of] + np.arange(int(width.sum())) - first[of]
    groups, pairs = [group[of]], [(a[rows][of].astype(np.int64) << 32) | b[right]]
    times = [np.ones(len(of), np.int64)]
    for g in np.flatnonzero(~small).tolist():
        x, nx = np.unique(a[start_a[g] : start_a[g] + p[g]], return_counts=True)
        y, ny = np.unique(b[start_b[g] : start_b[g] + q[g]], return_counts=True)
        pairs.append(((x.astype(np.int64) << 32)[:, None] | y[None, :]).ravel())
        times.append((nx[:, None] * ny[None, :]).ravel())
        groups.append(np.full(len(x) * len(y), g))
    return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)


class Aligner:
    def __init__(self, vocabulary: bytes, model: bytes, cache_words: int = CACHE_WORDS):
        self.bytewise, self.pieces = Bytewise(vocabulary), Pieces(model)
        self.a_bytes, self.b_bytes = self.bytewise.token, self.pieces.token
        most = len(self.a_bytes)
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # ids as text, with what follows them: in a group, at its end
        self.said = [b"%d%s" % (i, end) for n, ends in ((most, (b",", b"|")), (len(self.b_bytes), (b",", b";"))) for end in ends for i in range(n)]
        self.most = most
        self.cache_words = cache_words
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.aged: dict[str, tuple[bytes, bytes] | None] = {}

    def _checked(self, spaced: str, x: bytes, y: bytes) -> tuple[bytes, bytes] | None:
        """The ids of both sides, if both give the text back."""
        want = spaced.encode()
        return (x, y) if self._joined(x, self.a_bytes) == want == self._joined(y, self.b_bytes) else None

    def _learn(self, words: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """What both sides make of a blank and each word; None where the word has
        to be seen with the text around it."""
        found = dict.fromkeys(words)
        good = [w for w in words if w and w.strip(bpe.BLANKS) == w] if self.pieces.by_word else []
        if good:
            spaced = [" " + w for w in good]
            xs, ys = self.bytewise.encode_words(spaced), self.pieces.encode(good)
            for at in range(0, len(good), CHECKED_WORDS):
                part = slice(at, at + CHECKED_WORDS)
                want = [w.encode() for w in spaced[part]]
                if self._all_joined(xs[part], self.a_bytes, self.a_size, want) and self._all_joined(ys[part], self.b_bytes, self.b_size, want):
                    found |= zip(good[part], zip(xs[part], ys[part]))
                else:
                    found |= {w: self._checked(*c) for w, c in zip(good[part], zip(spaced[part], xs[part], ys[part]))}
        return found

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both sides; none where either side does not give the text back."""
        split = [t.split(" ") for t in texts]
        if len(self.known) > self.cache_words:
            self.known, self.aged = {}, self.known
        new = set().union(*split).difference(self.known)
        self.known |= {w: self.aged[w] for w in new if w in self.aged}
        new.difference_update(self.known)
        self.known |= self._learn([w for w in new if len(w) <= CACHE_CHARS])
        long = [w for w in new if len(w) > CACHE_CHARS]
        get = (self.known | self._learn(long)).__getitem__ if long else self.known.__getitem__
        out = []
        for t, words in zip(texts, split):
            parts = list(map(get, words))
            if None in parts:
                whole = self._checked(" " + t, *self.bytewise.encode([" " + t]), *self.pieces.encode([t])) if t else None
                out.append(whole or (b"", b""))
            else:
                x, y = zip(*parts)
                out.append((b"".join(x), b"".join(y)))
        return out

    @staticmethod
    def _joined(ids: bytes, tokens: list[bytes]) -> bytes:
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")])

    @staticmethod
    def _all_joined(ids: list[bytes], tokens: list[bytes], sizes: np.ndarray, want: list[bytes]) -> bool:
        """Whether each of some lists of ids gives the bytes wanted."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        ends = np.cumsum([len(x) // 4 for x in ids])
        if not np.array_equal(np.r_[0, np.cumsum(sizes[flat])][ends], np.cumsum([len(w) for w in want])):
            return False
        return b"".join(map(tokens.__getitem__, flat.tolist())) == b"".join(want)

    @uncollected()
    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each text."""
        coded = self.encode(texts)
        n_a, n_b = (np.array([len(c[k]) // 4 for c in coded], np.int64) for k in (0, 1))
        a, b = (np.frombuffer(b"".join(c[k] for c in coded), "<u4").astype(np.int64) for k in (0, 1))
        ga, gb = common_ends(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        p, q = np.diff(ga, prepend=-1), np.diff(gb, prepend=-1)
        # which text a group is of
        ends = np.searchsorted(ga, np.cumsum(n_a) - 1, "right") if len(ga) else np.zeros(len(texts), np.int64)
        ends = np.maximum.accumulate(np.where(n_a > 0, ends, 0)) if len(texts) else ends
        first = np.r_[0, ends[:-1]] if len(texts) else ends
        # both sides' tokens in the order in which the groups are written
        codes = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ga], last_b[gb] = 1, 1
        codes[np.arange(len(a)) + np.repeat(np.cumsum(q) - q, p)] = a + self.most * last_a
        codes[np.arange(len(b)) + np.repeat(np.cumsum(p), q)] = b + 2 * self.most + len(self.b_bytes) * last_b
        stop = np.cumsum(n_a + n_b)
        group, pairs, times = linked(a, b, p, q)
        owner = np.repeat(np.arange(len(texts)), ends - first)[group] if len(group) else group
        order = np.argsort(owner, kind="stable")
        pairs, times = pairs[order], times[order]
        cut = np.searchsorted(owner[order], np.arange(len(texts) + 1))
        links = np.r_[0, np.cumsum(p * q)]
        out = []
        for k in range(len(texts)):
            if not n_a[k]:
                out.append((0, 0, 0, 0, "", pairs[:0], times[:0]))
                continue
            words = map(self.said.__getitem__, codes[stop[k] - n_a[k] - n_b[k] : stop[k]].tolist())
            digest = hashlib.sha256(b"".join(words)[:-1]).hexdigest()
            distinct, back = np.unique(pairs[cut[k] : cut[k + 1]], return_inverse=True)
            count = np.bincount(back, times[cut[k] : cut[k + 1]], len(distinct)).astype(np.int64)
            out.append((int(n_a[k]), int(n_b[k]), int(ends[k] - first[k]), int(links[ends[k]] - links[first[k]]), digest, distinct, count))
        return out


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in their order, about ``GROUP_BYTES`` at a time."""
    group, size = [], 0
    for t in texts:
        group.append(t.as_py() or "")
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


_FACTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def aligned(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """(doc_id, block, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of
    each row: the distinct pairs of ids that it links, and how often."""
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast((load(vocabulary or bpe.vocabulary_path()), load(pieces or bpe.vocabulary_path(PIECES))))
    key = sent._jbroadcast.id()
    blocks = block_count(docs, "text", BLOCK_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = rows.withColumn("block", row_block(blocks, "doc_id"))
    names = ["doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("align", key), lambda: Aligner(*sent.value))
        for batch in batches:
            at = 0
            for group in _groups(batch.column("text")):
                found = aligner.align(group)
                head = batch.slice(at, len(group))
                at += len(group)
                facts = [pa.array([f[k] for f in found], pa.string() if k == 4 else pa.int64()) for k in range(5)]
                size = pa.array(np.r_[0, np.cumsum([len(f[5]) for f in found])], pa.int32())
                lists = [pa.ListArray.from_arrays(size, pa.array(np.concatenate([f[k] for f in found]))) for k in (5, 6)]
                yield pa.RecordBatch.from_arrays([head.column("doc_id"), head.column("block"), *facts, *lists], names)

    return rows.mapInArrow(run, f"doc_id bigint, block int, {_FACTS}, pairs array<bigint>, times array<bigint>")


def pair_counts(by_block: DataFrame) -> DataFrame:
    """(pair, n, best) from (block, pair, n): documents that hold a pair, and
    whether no pair with its A id is held by more."""
    from pyspark.sql import Window

    counts = by_block.groupBy("pair").agg(F.sum("n").alias("n"))
    # at most one row for each B id of an A id
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("n") == most)


def scored(rows: DataFrame) -> DataFrame:
    """``aligned`` rows with ``n_best`` and ``count_sum`` in place of their pairs."""
    spark = rows.sparkSession
    by_block = staged(spark, rows.select("block", F.explode("pairs").alias("pair")).groupBy("block", "pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    release(spark)
    counts = staged(spark, pair_counts(by_block), "counts")
    release(spark)
    facts = by_block.select("block", "pair").join(counts, "pair")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        drop_held()
        pair, n, best = (right.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pair)
        pair, n, best = pair[order], n[order], best[order]
        sums = [], []
        for chunk in left.to_batches(max_chunksize=512):
            lists = chunk.column("pairs")
            times = chunk.column("times").flatten().to_numpy()
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            edge = np.r_[0, np.cumsum(size)]
            for into, value in zip(sums, (times * best[at], times * n[at])):
                total = np.r_[0, np.cumsum(value)]
                into.append(total[edge[1:]] - total[edge[:-1]])
        added = [pa.array(np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64)) for x in sums]
        return pa.Table.from_arrays([*(left.column(c) for c in names[:6]), *added], names)

    blocks = max(1, rows.select("block").distinct().count())
    rows, facts = rows.repartition(blocks, "block"), facts.repartition(blocks, "block")
    return rows.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(run, f"doc_id bigint, {_FACTS}, n_best bigint, count_sum bigint")


def alignment(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """The facts of each document, corpus counts included."""
    spark = docs.sparkSession
    rows = staged(spark, aligned(docs, vocabulary, pieces), "aligned")
    return scored(rows)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents").select("doc_id", "text"))
