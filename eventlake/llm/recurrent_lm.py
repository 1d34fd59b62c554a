"""Language-model scoring with a gated recurrent network in numpy.

Counts: the words of all training documents are counted by Spark. The
``SHORTLIST`` most frequent words are outputs of the network; every other word
belongs to a spelling group (its end, its letters, its length), whose counts
spread the group's probability over its words, unseen ones included.

Network: embedding, one GRU layer, and an output softmax factored by class:
P(word) = P(class | state) * P(word | class, state); spelling groups and the
end of a text are classes of their own.

Training: truncated backpropagation. A round learns from every window of every
training document; the state is carried from one window of a text to the next
and the gradient stops at the window. Tasks start a round from the same
weights, and Spark averages what they learn, weighted by tokens. A task's
share of the texts follows their bytes, not the number of input partitions,
and grows with the corpus as the number of tasks does.

Scoring: whole documents lie end to end in lanes; the state is carried across
windows and reset where a document begins, so a score is the complete log10
probability. The counts a block of documents needs are joined by word, one
dictionary per block.

Defined results: a null or empty text is one end token; a null doc_id counts
as held out; repeated rows are scored each; extra columns are ignored; an
empty table gives no rows; without training text every count is 0 and the
base has its 0.1 only. A word or text may have any length.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import block_count, drop_held, row_block, ship, staged, table

SHORTLIST = 1024
CLASSES = 32
HIDDEN = 24
EMBED = 16
#: Steps of a window, documents trained side by side, scored side by side.
STEPS, TRAIN_LANES, SCORE_LANES = 32, 64, 512
ROUNDS = 2
#: Text of a training task where the corpus has no more.
TASK_BYTES = 2 << 20
#: Tokens laid out in lanes at once, at most (but for a longer text).
GROUP_TOKENS = 1 << 21
RATE = 0.01
BLOCK_BYTES = 24 << 20
#: Text that is split into words at a time, and of which words are counted at a time.
SPLIT_BYTES, COUNTED_BYTES = 4 << 20, 8 << 20
END = b"\n"

_ENDS = {46: 1, 44: 2, 33: 3, 63: 3}
#: Letters that tell languages apart, as UTF-8 continuations of C3.
_MARKS = [b"\xc3\xa4\xc3\xb6\xc3\xbc\xc3\x9f", b"\xc3\xb1\xc3\xad\xc3\xb3\xc3\xba\xc3\xa1", b"\xc3\xa8\xc3\xaa\xc3\xa7\xc3\xa0\xc3\xa2\xc3\xb9\xc3\xae\xc3\xb4"]
GROUPS = 4 * 5 * 3
#: Of a last byte, its end; of a byte after C3, a bit for its letters; of such bits
#: (8: any byte beyond ASCII), the first mark.
_END_OF, _MARK_OF = np.zeros(256, np.int32), np.zeros(256, np.uint8)
_END_OF[list(_ENDS)] = list(_ENDS.values())
for _k, _letters in enumerate(_MARKS):
    _MARK_OF[list(_letters[1::2])] |= 1 << _k
_FIRST_MARK = np.array([0] + [1 + ((m & -m).bit_length() - 1) for m in range(1, 16)], np.int32)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins (and the last one ends), and the bytes."""
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    return edges, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def split_words(texts: pa.Array | pa.ChunkedArray, at_once: int | None = None) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """The words of a column of texts, about ``SPLIT_BYTES`` of text at a time: how
    many each text has, and all of them one after another."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        chunk = chunk.cast(pa.binary()).fill_null(b"")
        size = np.cumsum(pc.binary_length(chunk).to_numpy(zero_copy_only=False), dtype=np.int64) // (at_once or SPLIT_BYTES)
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(chunk)]
        for a, b in zip(cuts, cuts[1:]):
            # bytes are viewed as text, as the functions for words ask for; none looks beyond ASCII
            lists = pc.ascii_split_whitespace(pc.ascii_lower(chunk.slice(a, b - a).view(pa.string())))
            words = lists.flatten()
            some = pc.greater(pc.binary_length(words), 0)  # a blank at an end gives an empty one
            before = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))
            yield np.diff(before[lists.offsets.to_numpy()]), words.filter(some).view(pa.binary())


def groups_of(words: pa.Array) -> np.ndarray:
    """Spelling group of words, none empty: how a word ends, which marked letters
    it has, its length."""
    if not len(words):
        return np.zeros(0, np.int32)
    edges, data = _buffers(words)
    first, data = edges[:-1] - edges[0], data[edges[0] : edges[-1]]
    last = edges[1:] - edges[0] - 1
    end = _END_OF[data[last]]
    n = last - first + 1 - (end > 0)
    mark = np.zeros(len(data), np.uint8)
    mark[data >= 0x80] = 8
    at = np.flatnonzero(data[:-1] == 0xC3)
    mark[at] |= _MARK_OF[data[at + 1]]
    mark[last] &= 8  # the next byte is another word's
    return (end * 5 + _FIRST_MARK[np.bitwise_or.reduceat(mark, first)]) * 3 + (n > 4) + (n > 9)


@dataclass
class Vocabulary:
    """Fixed-size statistics every task needs."""

    ids: dict[bytes, int]
    class_of: np.ndarray  # class of every shortlisted word
    n_classes: int
    total: int  # training tokens
    distinct: int
    group_log: np.ndarray  # log10 of a group's denominator
    start: np.ndarray  # log counts of shortlisted words
    class_start: np.ndarray

    @property
    def outputs(self) -> int:
        return self.n_classes + GROUPS + 1

    @property
    def words(self) -> pa.Array:
        return pa.array(list(self.ids), pa.binary())

    @property
    def end_id(self) -> int:
        return len(self.ids) + GROUPS


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n, grp) over all training documents; the end is a word of its own."""

    def rows_of(words: pa.Array, n: pa.Array, grp: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([words, n, pa.array(grp, pa.int32())], ["word", "n", "grp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        ends = 0
        for batch in batches:
            ends += batch.num_rows
            for _, words in split_words(batch.column("_text"), COUNTED_BYTES):
                counts = pc.value_counts(words)
                yield rows_of(counts.field("values"), counts.field("counts"), groups_of(counts.field("values")))
        if ends:
            yield rows_of(pa.array([END], pa.binary()), pa.array([ends], pa.int64()), np.array([-1]))

    rows = docs.filter(~held_out()).select(F.col("text").cast("binary").alias("_text"))
    parts = rows.mapInArrow(run, "word binary, n bigint, grp int")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.first("grp").alias("grp"))


def vocabulary(counts: DataFrame, shortlist: int = SHORTLIST, classes: int = CLASSES) -> Vocabulary:
    """Top words (a bounded list), classes of about equal root frequency, and
    the totals of the spelling groups."""
    top = counts.filter("grp >= 0").orderBy(F.desc("n"), "word").limit(shortlist).collect()
    total, distinct, ends = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("grp") < 0, F.col("n")))).first()
    groups = {r["grp"]: (r["n"], r["v"]) for r in counts.filter("grp >= 0").groupBy("grp").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    n, v = np.zeros(GROUPS), np.zeros(GROUPS)
    for g, (a, b) in groups.items():
        n[g], v[g] = a, b
    ids, freq = {}, np.array([r["n"] for r in top], float)
    for i, r in enumerate(top):
        ids[bytes(r["word"])] = i
        n[r["grp"]] -= r["n"]
        v[r["grp"]] -= 1
    share = np.cumsum(np.sqrt(freq)) / max(np.sqrt(freq).sum(), 1e-9)
    class_of = np.minimum((share * classes).astype(int), classes - 1) if len(freq) else np.zeros(0, int)
    class_of = np.unique(class_of, return_inverse=True)[1] if len(freq) else class_of
    n_classes = int(class_of.max()) + 1 if len(freq) else 0
    mass = np.concatenate((np.bincount(class_of, freq, n_classes), n + 0.1, [float(ends or 0) + 0.1])) + 1e-3
    return Vocabulary(
        ids, class_of, n_classes, int(total or 0), int(distinct or 0), np.log10(n + 0.1 * (v + 1)),
        np.log(freq).astype(np.float32), np.log(mass / mass.sum()).astype(np.float32),
    )


def first_weights(vocab: Vocabulary, hidden: int = HIDDEN, embed: int = EMBED) -> dict[str, np.ndarray]:
    """Small random weights; output biases begin at the counted frequencies."""
    rng = np.random.RandomState(7)
    small = lambda *shape: (rng.randn(*shape) * 0.1).astype(np.float32)
    return {
        "E": small(vocab.end_id + 1, embed), "W": small(embed, 3 * hidden), "b": np.zeros(3 * hidden, np.float32), "U": small(hidden, 3 * hidden),
        "C": small(hidden, vocab.outputs), "c": vocab.class_start.copy(), "O": small(hidden, len(vocab.ids)) * 0.1, "o": vocab.start.copy(),
    }


def _gru(x: np.ndarray, h: np.ndarray, reset: np.ndarray, U: np.ndarray, keep: bool):
    """States of a window: ``x`` (steps, lanes, 3H) is the projected input."""
    steps, lanes, width = x.shape
    H = width // 3
    out = np.empty((steps, lanes, H), x.dtype)
    # gates apart: what a step works on lies together. They take exp(-v): the sign
    # is turned beforehand
    gates = np.ascontiguousarray(x.reshape(steps, lanes, 3, H).transpose(0, 2, 1, 3))
    np.negative(gates[:, :2], out=gates[:, :2])
    U = np.ascontiguousarray(U.reshape(H, 3, H).transpose(1, 0, 2))
    np.negative(U[:2], out=U[:2])
    from_states = np.empty((steps if keep else 1, 3, lanes, H), x.dtype)
    first, resets = h, reset.any(axis=1)
    for t in range(steps):
        if resets[t]:
            h = np.where(reset[t][:, None], x.dtype.type(0), h)
        g = np.matmul(h, U, out=from_states[t if keep else 0])
        zr, n, new = gates[t, :2], gates[t, 2], out[t]
        zr += g[:2]
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        np.multiply(zr[1], g[2], out=new)
        n += new
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= zr[0]
        new += n
        h = new
    if not keep:
        return out, h, None
    before = np.concatenate((first[None], out[:-1]))
    before[reset] = 0
    return out, h, (before, gates[:, 0], gates[:, 1], gates[:, 2], from_states[:, 2])


def _and_one(states: np.ndarray) -> np.ndarray:
    """States with a last component for the biases."""
    return np.concatenate((states, np.ones((len(states), 1), states.dtype)), axis=1)


def _wide(weight: np.ndarray) -> bool:
    """Whether exp() of a projected state could leave the range of floats. A state's
    components lie between -1 and 1."""
    return bool(weight.size and np.abs(weight).sum(axis=0).max() > 60)


def _exp(x: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """exp(x), in place, by row up to a factor, and the sums of the rows."""
    if wide:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], x.dtype)


def _members(vocab: Vocabulary) -> list[slice]:
    """The shortlist is sorted by count, so a class is a stretch of it."""
    edges = np.searchsorted(vocab.class_of, np.arange(vocab.n_classes + 1))
    return [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _classes(vocab: Vocabulary, target: np.ndarray) -> np.ndarray:
    """Output class of token ids (shortlist, groups, end)."""
    table_ = np.concatenate((vocab.class_of, vocab.n_classes + np.arange(GROUPS + 1))).astype(np.int64)
    return table_[target]


def log_probs(w: dict, vocab: Vocabulary, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of token ids, without the share inside a group."""
    cls, rows, states = _classes(vocab, target), np.arange(len(target)), _and_one(states)
    C, O = np.vstack((w["C"], w["c"])), np.vstack((w["O"], w["o"]))
    p, total = _exp(states @ C, _wide(C))
    out = np.log(p[rows, cls] / total)
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(vocab.n_classes + 1)).tolist()
    by_class, target_of, wide = states[order], target[order], _wide(O)
    inside = np.zeros_like(out)
    for k, part in enumerate(_members(vocab)):
        a, b = edges[k], edges[k + 1]
        if b > a and part.stop - part.start > 1:
            p, total = _exp(by_class[a:b] @ O[:, part], wide)
            inside[a:b] = np.log(p[rows[: b - a], target_of[a:b] - part.start] / total)
    out[order] += inside
    return out


def gradients(w: dict, vocab: Vocabulary, ids: np.ndarray, target: np.ndarray, reset: np.ndarray, h: np.ndarray):
    """Loss gradients of one window (steps, lanes) and the state after it;
    targets below 0 are padding."""
    H, tokens = w["U"].shape[0], ids.reshape(-1)
    embedded = _and_one(w["E"][tokens])
    x = (embedded @ np.vstack((w["W"], w["b"]))).reshape(*ids.shape, 3 * H)
    states, last, tape = _gru(x, h, reset, w["U"], True)
    flat, want = states.reshape(-1, H), target.reshape(-1)
    live = np.flatnonzero(want >= 0)
    scale = x.dtype.type(1 / max(1, len(live)))
    cls = _classes(vocab, want[live])
    order = np.argsort(cls, kind="stable")  # places of a class lie together
    cls, live = cls[order], live[order]
    edges = np.searchsorted(cls, np.arange(vocab.n_classes + 1)).tolist()
    s, want = _and_one(flat[live]), want[live]
    C, O = np.vstack((w["C"], w["c"])), np.vstack((w["O"], w["o"]))
    p, total = _exp(s @ C, _wide(C))
    p *= (scale / total)[:, None]
    p[np.arange(len(cls)), cls] -= scale
    grad, of_C, of_O = {}, s.T @ p, np.zeros_like(O)
    ds = p @ w["C"].T
    wide = _wide(O)
    for k, part in enumerate(_members(vocab)):
        a, b = edges[k], edges[k + 1]
        if b > a and part.stop - part.start > 1:
            mine = s[a:b]
            q, total = _exp(mine @ O[:, part], wide)
            q *= (scale / total)[:, None]
            q[np.arange(b - a), want[a:b] - part.start] -= scale
            of_O[:, part] = mine.T @ q
            ds[a:b] += q @ w["O"][:, part].T
    grad["C"], grad["c"], grad["O"], grad["o"] = of_C[:-1], of_C[-1], of_O[:-1], of_O[-1]
    back = np.zeros_like(flat)
    back[live] = ds
    back = back.reshape(states.shape)
    before, z, r, n, gn = tape
    # a step's gates' gradients are these shares of its state's gradient
    share = np.empty((3, *z.shape), x.dtype)
    np.multiply(1 - z, 1 - n * n, out=share[2])
    np.multiply((before - n) * z, 1 - z, out=share[0])
    np.multiply(share[2] * gn, r * (1 - r), out=share[1])
    to_input = share[2].copy()
    share[2] *= r
    dh, resets = np.zeros_like(h), reset.any(axis=1)
    back_u = np.ascontiguousarray(w["U"].reshape(H, 3, H).transpose(1, 2, 0))
    for t in range(len(ids) - 1, -1, -1):
        d, now = back[t], share[:, t]
        d += dh
        now *= d
        dh = np.add.reduce(now @ back_u, axis=0)
        dh += d * z[t]
        if resets[t]:
            dh[reset[t]] = 0
    flat = share.reshape(3, -1, H)
    grad["U"] = np.concatenate(list(before.reshape(-1, H).T @ flat), axis=1)
    np.multiply(to_input, back, out=share[2])
    of_W = np.concatenate(list(embedded.T @ flat), axis=1)
    grad["W"], grad["b"] = of_W[:-1], of_W[-1]
    of_input = np.add.reduce(flat @ w["W"].reshape(-1, 3, H).transpose(1, 2, 0), axis=0)
    # sums by token
    grad["E"] = np.zeros_like(w["E"])
    order = np.argsort(tokens, kind="stable")
    tokens = tokens[order]
    first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    grad["E"][tokens[first]] = np.add.reduceat(of_input[order], first, axis=0)
    return grad, last


class TokenIds:
    """Token ids of texts: of the network's words, and by spelling group."""

    def __init__(self, vocab: Vocabulary):
        self.words = vocab.words

    def of(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=self.words)
        ids = found.fill_null(0).to_numpy().copy()
        rare = found.is_null()
        ids[rare.to_numpy(zero_copy_only=False)] = len(self.words) + groups_of(words.filter(rare))
        return ids

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for sizes, words in split_words(texts):
            yield from np.split(self.of(words), np.cumsum(sizes)[:-1])


def lanes_of(runs: list[np.ndarray], lanes: int, end: int):
    """Runs laid end to end in lanes of about equal length: inputs, targets
    (-1: padding), resets and the run of every place, as (steps, lanes)."""
    sizes = np.array([len(r) + 1 for r in runs])
    order = np.argsort(-sizes, kind="stable")
    # no more lanes than the longest run fills: the padding stays below the tokens
    lanes = max(1, min(lanes, len(runs), -(-int(sizes.sum()) // int(sizes.max()))))
    at = np.zeros(len(runs), np.int64)
    lane_of = np.zeros(len(runs), np.int64)
    free = [(0, lane) for lane in range(lanes)]
    for k in order.tolist():
        used, lane = heapq.heappop(free)
        lane_of[k], at[k] = lane, used
        heapq.heappush(free, (used + int(sizes[k]), lane))
    steps = max(used for used, _ in free)
    ids, target = np.full((lanes, steps), end, np.int32), np.full((lanes, steps), -1, np.int32)
    reset, owner = np.zeros((lanes, steps), bool), np.zeros((lanes, steps), np.int32)
    for k, run in enumerate(runs):
        lane, a = lane_of[k], at[k]
        b = a + len(run)
        ids[lane, a + 1 : b + 1], target[lane, a:b], target[lane, b] = run, run, end
        reset[lane, a] = True
        owner[lane, a : b + 1] = k
    return ids.T, target.T, reset.T, owner.T


def learner(w: dict) -> tuple[dict, dict]:
    """A copy of the weights as parts of one vector, and what Adam keeps for it."""
    flat = np.concatenate([x.ravel() for x in w.values()])
    parts = np.split(flat, np.cumsum([x.size for x in w.values()])[:-1])
    return {k: part.reshape(x.shape) for (k, x), part in zip(w.items(), parts)}, {"t": 0, "w": flat, "m": np.zeros_like(flat), "v": np.zeros_like(flat)}


def train_runs(w: dict, vocab: Vocabulary, runs: list[np.ndarray], adam: dict) -> int:
    """Adam steps over the windows of some runs, in place; the tokens seen."""
    ids, target, reset, _ = lanes_of(runs, TRAIN_LANES, vocab.end_id)
    h = np.zeros((ids.shape[1], w["U"].shape[0]), np.float32)
    m, v, small = adam["m"], adam["v"], np.float32(1e-8)
    for a in range(0, len(ids), STEPS):
        part = slice(a, a + STEPS)
        grad, h = gradients(w, vocab, ids[part], target[part], reset[part], h)
        g = np.concatenate([grad[k].ravel() for k in w])
        g /= np.float32(max(1.0, float(np.sqrt(g @ g))))
        adam["t"] += 1
        rate = RATE * np.sqrt(1 - 0.999 ** adam["t"]) / (1 - 0.9 ** adam["t"])
        m *= np.float32(0.9)
        m += g * np.float32(0.1)
        v *= np.float32(0.999)
        g *= g
        g *= np.float32(0.001)
        v += g
        step = np.sqrt(v, out=g)
        step += small
        np.divide(m, step, out=step)
        step *= np.float32(rate)
        adam["w"] -= step
    return int((target >= 0).sum())


def train_tasks(docs: DataFrame, column: str) -> int:
    """Number of training tasks. With more text there are more tasks to average
    and each makes more steps from the common start (by the cube root)."""
    return math.ceil(block_count(docs, column, TASK_BYTES) ** (2 / 3))


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights after ``rounds`` of training on all words of all training documents."""
    spark = ship(docs.sparkSession)
    w = first_weights(vocab)
    names, shapes = list(w), [v.shape for v in w.values()]
    rows = docs.filter(~held_out()).select(F.col("text").cast("binary").alias("_text"))
    rows = rows.coalesce(train_tasks(rows, "_text"))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((w, vocab))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            drop_held()
            first, v = sent.value
            own, adam = learner(first)
            ids = TokenIds(v)
            seen, runs, tokens, longest = 0, [], 0, 1024
            for batch in batches:
                for found in ids.of_texts(batch.column("_text")):
                    runs.append(found)
                    tokens += len(runs[-1]) + 1
                    longest = max(longest, len(runs[-1]) + 1)
                    # the longest text is a lane, and the others fill the rest
                    if tokens >= min(TRAIN_LANES * longest, GROUP_TOKENS):
                        seen += train_runs(own, v, runs, adam)
                        runs, tokens, longest = [], 0, 1024
            if runs:
                seen += train_runs(own, v, runs, adam)
            if seen:
                flat = adam["w"].astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))], ["pos", "value", "weight"]
                )

        learned = rows.mapInArrow(run, "pos int, value double, weight double").groupBy("pos").agg((F.sum("value") / F.sum("weight")).alias("value"))
        got = learned.toPandas()  # one row per weight: the size of the network
        if len(got):
            flat = np.empty(len(got), np.float32)
            flat[got["pos"].to_numpy()] = got["value"].to_numpy()
            cut = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
            w = {k: part.reshape(s).copy() for k, s, part in zip(names, shapes, np.split(flat, cut))}
        sent.unpersist()
    return w


class Counts:
    """Counts and token ids of the words of a block, by place in two arrays."""

    def __init__(self, vocab: Vocabulary, words: pa.Array, n: np.ndarray):
        self.words, self.n = words, n.astype(np.float64)
        self.ids = TokenIds(vocab).of(words)
        self.end = pc.index(words, pa.scalar(END, pa.binary())).as_py()
        self.ids[self.end] = vocab.end_id

    @classmethod
    def of(cls, vocab: Vocabulary, counts: dict[bytes, int]) -> "Counts":
        return cls(vocab, pa.array(list(counts), pa.binary()), np.array(list(counts.values())))

    def places(self, words: pa.Array) -> np.ndarray:
        return pc.index_in(words, value_set=self.words).to_numpy()


def score_texts(w: dict, vocab: Vocabulary, texts: Iterable[list[bytes]], counts: Counts):
    """``score_places`` of texts given by their words."""
    return score_places(w, vocab, (counts.places(pa.array(words, pa.binary())) for words in texts), counts)


def score_places(w: dict, vocab: Vocabulary, texts: Iterable[np.ndarray], counts: Counts):
    """Per text: tokens, known tokens, base score, model score (log10).
    ``counts`` has every word of the texts and the end; a text is given by the
    places of its words there."""
    denominator = np.log10(vocab.total + 0.1 * (vocab.distinct + 1))
    end, first = counts.end, len(vocab.ids)
    # the share of a word inside its spelling group; 0 for words of the network
    logs = np.log10(counts.n + 0.1)
    rare = (counts.ids >= first) & (counts.ids < vocab.end_id)
    share = np.zeros(len(logs))
    share[rare] = logs[rare] - vocab.group_log[counts.ids[rare] - first]
    seen, small = counts.n > 0, counts.ids.astype(np.int32)
    runs, known, base, model = [], [], [], []
    for at in texts:
        known.append(int(seen[at].sum()) + int(seen[end]))
        base.append(float(logs[at].sum() + logs[end] - (len(at) + 1) * denominator))
        model.append(float(share[at].sum()))
        runs.append(small[at])
    tokens = np.array([len(r) + 1 for r in runs], np.int64)
    known, base, model = np.array(known, np.int64), np.array(base, float), np.array(model, float)
    if not runs:
        return tokens, known, base, model
    ids, target, reset, owner = lanes_of(runs, SCORE_LANES, vocab.end_id)
    project = w["E"] @ w["W"] + w["b"]
    h = np.zeros((ids.shape[1], w["U"].shape[0]), np.float32)
    for a in range(0, len(ids), STEPS):
        part = slice(a, a + STEPS)
        live = target[part] >= 0
        lanes = np.flatnonzero(live.any(axis=0))
        states, h[lanes], _ = _gru(project[ids[part][:, lanes]], h[lanes], reset[part][:, lanes], w["U"], False)
        live, want = live[:, lanes], target[part][:, lanes]
        logs = log_probs(w, vocab, states[live], want[live])
        model += np.bincount(owner[part][:, lanes][live], logs, len(runs)) / np.log(10)
    return tokens, known, base, model


def score(docs: DataFrame, w: dict, vocab: Vocabulary, counts: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast((w, vocab))
    blocks = block_count(docs, "text", BLOCK_BYTES)
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("binary").alias("_text"), row_block(blocks, "doc_id", "text").alias("_block")
    ).repartition("_block")

    def needed(rows: pa.Table) -> pa.Table:
        found = [words.unique() for _, words in split_words(rows["_text"])]
        words = pa.concat_arrays([pa.array([END], pa.binary()), *found]).unique()
        return pa.table({"_block": pa.repeat(rows["_block"][0], len(words)), "word": words})

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        weights, v = sent.value
        counts_ = Counts(v, right["word"].combine_chunks(), right["n"].to_numpy())
        places = (at for sizes, words in split_words(left["_text"]) for at in np.split(counts_.places(words), np.cumsum(sizes)[:-1]))
        tokens, known, base, model = score_places(weights, v, places, counts_)
        return pa.table(
            {
                "doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": pa.array(tokens), "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array([v.total] * len(tokens), pa.int64()), "base_score": pa.array(base), "score": pa.array(model),
            }
        )

    words = placed.groupBy("_block").applyInArrow(needed, "_block int, word binary")
    found = words.join(counts.select("word", "n"), "word", "left").select("_block", "word", F.coalesce("n", F.lit(0)).alias("n"))
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return placed.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(scored, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = staged(spark, count_words(docs), "words")
    vocab = vocabulary(counts)
    return score(docs, train(docs, vocab), vocab, counts)
