"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventlake.llm import bpe
from eventlake.llm import token_alignment as TA


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path(TA.PIECES))


def plain(libraries, rows):
    """[(doc_id, n_a, n_b, n_groups, n_links, sha, n_best, count_sum)]"""
    t, sp = libraries
    letters = bpe._byte_letters()
    done = []
    for doc, text in rows:
        a, b = t.encode(" " + (text or ""), add_special_tokens=False).ids, sp.encode(text or "")
        ab = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
        bb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        want = (" " + (text or "")).encode()
        if not text or b"".join(ab) != want or b"".join(bb) != want:
            done.append((doc, [], [], []))
            continue
        ends = set(np.cumsum([len(x) for x in ab]).tolist()) & set(np.cumsum([len(x) for x in bb]).tolist())
        groups, at = [], [0, 0, 0, 0]  # token and byte reached on both sides
        for e in sorted(ends):
            ga, gb = [], []
            while at[1] < e:
                ga.append(a[at[0]])
                at[1] += len(ab[at[0]])
                at[0] += 1
            while at[3] < e:
                gb.append(b[at[2]])
                at[3] += len(bb[at[2]])
                at[2] += 1
            groups.append((ga, gb))
        done.append((doc, a, b, groups))
    held = Counter(p for _, _, _, groups in done for p in {(x, y) for ga, gb in groups for x in ga for y in gb})
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc, a, b, groups in done:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        said = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        sha = hashlib.sha256(said.encode()).hexdigest() if groups else ""
        out.append((doc, len(a), len(b), len(groups), len(links), sha, sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links)))
    return sorted(out, key=str)


def test_common_ends_are_the_intersection():
    rng = np.random.default_rng(3)
    for n, keep in ((1, 1.0), (5, 0.5), (400, 0.97), (400, 0.6), (3000, 0.999), (3000, 0.05)):
        for _ in range(20):
            every = np.cumsum(rng.integers(1, 4, n))
            a, b = every[rng.random(n) < keep], every[rng.random(n) < keep]
            a, b = np.unique(np.r_[a, every[-1]]), np.unique(np.r_[b, every[-1]])
            i, j = TA.common_ends(a, b)
            want = np.intersect1d(a, b)
            assert (a[i] == want).all() and (b[j] == want).all()
    i, j = TA.common_ends(np.empty(0), np.empty(0))
    assert len(i) == len(j) == 0


def test_large_groups_are_counted_by_id():
    rng = np.random.default_rng(4)
    p, q = np.array([1, 2, 30, 1, 12]), np.array([1, 3, 40, 7, 12])
    a, b = rng.integers(0, 6, p.sum()), rng.integers(0, 6, q.sum())
    group, pair, times = TA.linked(a, b, p, q)
    got, want, at, bt = Counter(), Counter(), 0, 0
    for g, k, n in zip(group.tolist(), pair.tolist(), times.tolist()):
        got[g, k >> 32, k & 0xFFFFFFFF] += n
    for g in range(len(p)):
        want.update((g, x, y) for x in a[at : at + p[g]].tolist() for y in b[bt : bt + q[g]].tolist())
        at, bt = at + p[g], bt + q[g]
    assert got == want


ODD = [
    "  two  blanks   three ", " ", "   ", "\n", "a\n\n b\t c \n", "▁ mark", "<s>hi</s> <unk> <0x41> <|endoftext|>", "a\x00b", "é́ ﬁ ﬀ Å", "漢字 かな 한국어 🙂👩‍👩‍👧",
    "x" * 3000, "ab " * 700 + "🙂" * 300, "1234567890.12,5 don't we'll I'M", " nbsp thin　wide", "tab\tend\t", "end ",
]


def test_odd_texts_equal_the_libraries(spark, docs, libraries, monkeypatch):
    monkeypatch.setattr(TA, "BLOCK_BYTES", 20_000)
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "".join(rng.choice("ab é \n漢🙂'1.") for _ in range(rng.randint(1, 200)))) for i in range(40)]
    for df in (spark.createDataFrame(rows + rows[:3], "doc_id bigint, text string"), docs):
        want = plain(libraries, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
        out = TA.alignment(df)
        assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
        assert sorted(map(tuple, out.collect()), key=str) == want
    assert TA.alignment(docs.limit(0)).count() == 0


def test_words_forgotten_and_long_ones(libraries):
    texts = ["one two three " * 5 + "y" * 200, "four five  six", "one two", " one two", "two", "a\nb c\u3000d ▁ e", "漢字 🙂 " + "z" * 90]
    aligner = TA.Aligner(TA.load(bpe.vocabulary_path()), TA.load(bpe.vocabulary_path(TA.PIECES)), cache_words=2)
    t, sp = libraries
    for _ in range(3):
        for text, (a, b) in zip(texts, aligner.encode(texts)):
            want = ([], []) if "▁" in text else (t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text))
            assert (np.frombuffer(a, "<u4").tolist(), np.frombuffer(b, "<u4").tolist()) == want
    assert not any(len(w) > TA.CACHE_CHARS for w in aligner.known)


def test_query_equals_the_libraries(spark, libraries):
    from eventlake.llm.common import table
    from scales import SF_SMALL

    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, TA.query(spark, SF_SMALL).collect()), key=str) == plain(libraries, rows)


def test_words_encoded_together_are_as_each_alone(monkeypatch):
    rng = random.Random(5)
    words = ["", *["".join(rng.choice("abz é漢🙂'1.,-\t　▁<|>s") for _ in range(rng.randint(1, 9))).replace(" ", "_") for _ in range(600)], "don't", "<s>", "<|endoftext|>"]
    aligner = TA.Aligner(TA.load(bpe.vocabulary_path()), TA.load(bpe.vocabulary_path(TA.PIECES)))
    good = [w for w in words if w and w.strip(bpe.BLANKS) == w]
    spaced = [" " + w for w in good]
    assert aligner.bytewise.encode_words(spaced) == aligner.bytewise.encode(spaced)
    found = aligner._learn(words)
    for w, s, x, y in zip(good, spaced, aligner.bytewise.encode(spaced), aligner.pieces.encode(good)):
        assert found[w] == aligner._checked(s, x, y)
    assert all(found[w] is None for w in words if w not in good) and any("▁" in w for w in good)
    # one call for many words
    calls = []
    encode = aligner.bytewise.encode
    monkeypatch.setattr(aligner.bytewise, "encode", lambda texts: calls.append(len(texts)) or encode(texts))
    aligner._learn([f"word{i}" for i in range(1000)])
    assert sum(calls) <= -(-1000 // TA.JOINED_WORDS)


def test_cycles_are_not_searched_for_while_texts_are_aligned(libraries):
    import gc

    aligner = TA.Aligner(TA.load(bpe.vocabulary_path()), TA.load(bpe.vocabulary_path(TA.PIECES)))
    searches = lambda: sum(s["collections"] for s in gc.get_stats())
    texts = [" ".join(f"new{i}word{k}" for i in range(4000)) for k in range(10)]
    before = searches()
    aligner.align(texts)
    assert searches() - before <= 1 and gc.isenabled()
    with pytest.raises(AttributeError):
        aligner.align([0])
    assert gc.isenabled()
