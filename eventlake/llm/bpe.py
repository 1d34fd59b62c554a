"""BPE encoding and decoding: speculate, verify, repair.

A word is first cut greedily into the longest tokens. That is the right
encoding exactly if every token encodes to itself and every adjacent pair of
tokens, taken as one string, encodes to that pair. All pairs of the new words
of a batch are looked up at once (numpy over packed pairs); a pair not seen
before is decided once by exact merging. Only words with a failing pair are
merged exactly as a whole.

The vocabulary file (``tokenizers`` JSON, byte-level BPE) is a parameter; it
is read on the driver, which knows its size, and broadcast.

Defined results: a null text is empty and has no tokens; strings of added
tokens inside a text become those tokens, as in the library; repeated rows
are encoded each; extra columns are kept by ``encode``. Texts are never
shuffled; the word cache of a task is bounded, and a full one is emptied.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import held, in_slices, ship, table

VOCABULARY = "byte_bpe_50k.json"
#: Words up to so many bytes are merged by scanning, longer ones with a heap.
SHORT = 64
CACHE_WORDS = 400_000
#: Text of which ids and columns are made at a time.
SLICE_BYTES = 4 << 20
MAX_VOCABULARY_BYTES = 64 << 20

# Fixed value: the published pattern that splits text before byte-level merges,
# with white space spelled out as the Unicode property.
BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = re.escape(BLANKS)
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabulary files:
    printable bytes are themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> dict:
    """Plain tables of a vocabulary file, checked against a size limit."""
    raw = Path(path).read_bytes()
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: {len(raw)} bytes are more than a vocabulary may have")
    spec, letters = json.loads(raw), _byte_letters()
    as_bytes = lambda s: bytes(letters[c] for c in s)
    ids = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    for t in added:
        ids.pop(as_bytes(t) if all(c in letters for c in t) else b"", None)
    return {"ids": ids, "merges": [(as_bytes(a), as_bytes(b)) for a, b in merges], "added": added}


class Codec:
    def __init__(self, tables: dict, cache_words: int = CACHE_WORDS):
        self.ids: dict[bytes, int] = tables["ids"]
        self.token: dict[int, bytes] = {v: k for k, v in self.ids.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for a, b in tables["merges"]:
            if a in self.ids and b in self.ids and a + b in self.ids:
                self.rank.setdefault((self.ids[a], self.ids[b]), len(self.merged))
                self.merged.append(self.ids[a + b])
        self.none = len(self.merged)
        self.added: dict[str, int] = tables["added"]
        self.token |= {i: s.encode() for s, i in self.added.items()}
        self.split = regex.compile(PATTERN)
        special = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.reach: dict[bytes, int] = {}  # longest token that begins with these two bytes
        for t in self.ids:
            if len(t) > self.reach.get(t[:2], 0):
                self.reach[t[:2]] = len(t)
        self.words: dict[str, bytes] = {}
        self.cache: dict[str, bytes] = {}
        self.aged: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.cache_words = cache_words
        self.pairs, self.fits = np.empty(0, np.int64), np.empty(0, bool)
        self.own: dict[int, bool] = {}
        self.failed = 0

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the lowest rank, leftmost first."""
        ids = [self.ids[word[i : i + 1]] for i in range(len(word))]
        return self._merge_long(ids) if len(ids) > SHORT else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, to, none = self.rank.get, self.merged, self.none
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (r := min(ranks)) != none:
            i = ranks.index(r)
            ids[i : i + 2] = [to[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for words of any length."""
        n, rank, to = len(ids), self.rank, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = to[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [x for x in ids if x >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Longest token first."""
        if (whole := self.ids.get(word)) is not None:
            return [whole]
        out, at, n, ids, reach = [], 0, len(word), self.ids, self.reach
        while at < n:
            end = min(n, at + reach.get(word[at : at + 2], 1))
            while word[at:end] not in ids:
                end -= 1
            out.append(ids[word[at:end]])
            at = end
        return out

    def _fitting(self, pairs: np.ndarray) -> np.ndarray:
        """For packed pairs, whether exact merging leaves them as they are."""
        distinct, back = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.pairs, distinct)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == distinct[known]
        fits = np.zeros(len(distinct), bool)
        fits[known] = self.fits[at[known]]
        new = np.flatnonzero(~known)
        for k in new.tolist():
            a, b = int(distinct[k]) >> 32, int(distinct[k]) & 0xFFFFFFFF
            fits[k] = self.merge(self.token[a] + self.token[b]) == [a, b]
        if len(self.pairs) + len(new) > 8 * self.cache_words:
            self.pairs, self.fits = np.empty(0, np.int64), np.empty(0, bool)
        every = np.concatenate((self.pairs, distinct[new]))
        order = np.argsort(every, kind="stable")
        self.pairs, self.fits = every[order], np.concatenate((self.fits, fits[new]))[order]
        return fits[back]

    def _stands(self, token: int) -> bool:
        if token not in self.own:
            self.own[token] = self.merge(self.token[token]) == [token]
        return self.own[token]

    def learn(self, words: set[str]) -> None:
        """Encode new words and keep them, as little-endian ids."""
        new = list(words)
        proposed = [self.propose(w.encode()) for w in new]
        sizes = np.array([len(p) for p in proposed], np.int64)
        flat = np.array([t for p in proposed for t in p], np.int64)
        owner = np.repeat(np.arange(len(new)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        bad = np.zeros(len(new), bool)
        if len(inner):
            ok = self._fitting((flat[inner] << 32) | flat[inner + 1])
            bad[owner[inner[~ok]]] = True
        odd = [t for t in np.unique(flat).tolist() if not self._stands(t)]
        if odd:
            bad[owner[np.isin(flat, odd)]] = True
        for w, p, wrong in zip(new, proposed, bad.tolist()):
            self.words[w] = array("I", self.merge(w.encode()) if wrong else p).tobytes()
        self.failed += int(bad.sum())

    def pieces(self, text: str) -> list[str]:
        """The words of a text, and the added tokens in it."""
        if self.special is None or not any(s in text for s in self.added):
            return self.split.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self.split.findall(part)
        return out

    def _encode_pieces(self, groups: list[list[str]]) -> list[bytes]:
        new = set().union(*groups).difference(self.words)
        old = self.aged[0]
        if old:
            self.words |= {w: old[w] for w in new if w in old}
            new.difference_update(self.words)
        if new:
            self.learn(new)
        return [b"".join(map(self.words.__getitem__, g)) for g in groups]

    def _encode_stretches(self, texts: list[str]) -> list[bytes]:
        """A blank before a stretch without white space at its ends always
        belongs to the word after it, so such stretches are encoded once and
        kept. Texts with other stretches (None) are split as a whole."""
        split = [t.split(" ") for t in texts]
        new = {x for s in split for x in s[1:]}.difference(self.cache)
        old = self.aged[1]
        for x in new if old else ():
            if x in old:
                self.cache[x] = old[x]
        new = [x for x in new if x not in self.cache]
        good = [x for x in new if x and x.strip(BLANKS) == x]
        self.cache |= dict.fromkeys(new)
        self.cache |= zip(good, self._encode_pieces([self.split.findall(" " + x) for x in good]))
        first = self._encode_pieces([self.split.findall(s[0]) for s in split])
        out = []
        for text, start, stretches in zip(texts, first, split):
            parts = list(map(self.cache.__getitem__, stretches[1:]))
            if len(parts) and (None in parts or stretches[0].rstrip(BLANKS) != stretches[0]):
                out += self._encode_pieces([self.split.findall(text)])
            else:
                out.append(start + b"".join(parts))
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text, a group of texts at a time."""
        at = 0
        while at < len(texts):
            if max(len(self.cache), len(self.words)) > self.cache_words:
                self.aged = (self.words, self.cache)
                self.words, self.cache = {}, {}
            self.words |= {s: array("I", [i]).tobytes() for s, i in self.added.items()}
            group, chars = [], 0
            while at < len(texts) and chars < 1 << 20:
                group.append(texts[at])
                chars += len(texts[at])
                at += 1
            if any(s in t for t in group for s in self.added):
                yield from self._encode_pieces([self.pieces(t) for t in group])
            else:
                yield from self._encode_stretches(group)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _codec(sent, key: int) -> Codec:
    return held(("bpe", key), lambda: Codec(sent.value))


def encode(docs: DataFrame, path: str | None = None, ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, unless
    ``ids`` is false, ``token_ids``. Clashing columns of ``docs`` are replaced."""
    sent = ship(docs.sparkSession).sparkContext.broadcast(load_vocabulary(path or vocabulary_path()))
    key = sent._jbroadcast.id()
    added = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        *([T.StructField("token_ids", T.ArrayType(T.IntegerType()))] if ids else []),
    ]
    kept = docs.drop(*[f.name for f in added])
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, key)
        for batch in in_slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            coded = list(codec.encode_batch(texts))
            plain = [hashlib.sha256(codec.decode(c).encode()).hexdigest() for c in coded]
            columns = [
                *batch.columns,
                pa.array([len(c) // 4 for c in coded], pa.int64()),
                pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                pa.array(plain, pa.string()),
            ]
            if ids:
                ends = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
                flat = np.frombuffer(b"".join(coded), "<i4")
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, [*names, *(f.name for f in added)])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` with ``decoded``, the text of its ``token_ids`` (null: empty)."""
    sent = ship(coded.sparkSession).sparkContext.broadcast(load_vocabulary(path or vocabulary_path()))
    key = sent._jbroadcast.id()
    kept = coded.drop("decoded")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent, key)
        for batch in batches:
            texts = [codec.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ids=False).drop("text")
