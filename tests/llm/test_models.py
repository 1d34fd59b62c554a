"""The two language models and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import kneser_ney, recurrent_lm
from eventlake.llm.common import table
from scales import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def net():
    words = [f"w{i}".encode() for i in range(20)]
    vocab = recurrent_lm.Vocabulary(
        {w: i for i, w in enumerate(words)}, np.repeat(np.arange(4), 5), 4, 1000, 40, np.log10(np.arange(recurrent_lm.GROUPS) + 2.0),
        np.zeros(20, np.float32), np.zeros(4 + recurrent_lm.GROUPS + 1, np.float32),
    )
    return recurrent_lm.first_weights(vocab, 6, 5), vocab, words


def test_probabilities_sum_to_one(net):
    w, vocab, _ = net
    states = np.random.RandomState(1).randn(3, 6).astype(np.float32)
    every = np.arange(vocab.end_id + 1)
    for s in states:
        p = np.exp(recurrent_lm.log_probs(w, vocab, np.repeat(s[None], len(every), 0), every))
        assert abs(p.sum() - 1) < 1e-5


def test_gradients_match_differences(net):
    w, vocab, _ = net
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rng = np.random.RandomState(2)
    ids, target = rng.randint(0, vocab.end_id + 1, (5, 3)), rng.randint(-1, vocab.end_id + 1, (5, 3))
    reset = rng.rand(5, 3) < 0.2
    h = rng.randn(3, 6)

    def loss(w):
        states, _, _ = recurrent_lm._gru((w["E"] @ w["W"] + w["b"])[ids], h, reset, w["U"], False)
        live = target >= 0
        return -recurrent_lm.log_probs(w, vocab, states[live].astype(np.float64), target[live]).mean()

    grad, _ = recurrent_lm.gradients(w, vocab, ids, target, reset, h)
    for k in w:
        for _ in range(4):
            at = tuple(rng.randint(0, n) for n in w[k].shape)
            step = {x: v.copy() for x, v in w.items()}
            step[k][at] += 1e-2
            up = loss(step)
            step[k][at] -= 2e-2
            assert abs((up - loss(step)) / 2e-2 - grad[k][at]) < 2e-3, k


def test_state_is_carried_and_lanes_do_not_matter(net, monkeypatch):
    w, vocab, words = net
    rng = np.random.RandomState(3)
    texts = [[words[i] for i in rng.randint(0, 20, n)] + [b"rare"] * (n % 3) for n in (0, 1, 70, 5, 200, 33)]
    counts = recurrent_lm.Counts.of(vocab, {x: 3 for x in words} | {b"rare": 1, recurrent_lm.END: 5})
    whole = recurrent_lm.score_texts(w, vocab, texts, counts)
    monkeypatch.setattr(recurrent_lm, "STEPS", 7)
    monkeypatch.setattr(recurrent_lm, "SCORE_LANES", 2)
    parts = recurrent_lm.score_texts(w, vocab, texts, counts)
    alone = [recurrent_lm.score_texts(w, vocab, [t], counts)[3][0] for t in texts]
    assert np.allclose(whole[3], parts[3], rtol=1e-5) and np.allclose(whole[3], alone, rtol=1e-5)
    assert whole[0].tolist() == [len(t) + 1 for t in texts]


def test_scores(spark, docs):
    """Exact base scores on odd rows; on the table the model beats them."""
    for rows, better in ((docs, False), (table(spark, SF_CHECK, "documents"), True)):
        counts = recurrent_lm.staged(recurrent_lm.ship(spark), recurrent_lm.count_words(rows), "words")
        vocab = recurrent_lm.vocabulary(counts)
        got = recurrent_lm.score(rows, recurrent_lm.train(rows, vocab, rounds=1), vocab, counts).collect()
        texts = defaultdict(list)
        for r in rows.withColumn("held", recurrent_lm.held_out()).collect():
            texts[r["doc_id"]].append((r["held"], recurrent_lm.words_of((r["text"] or "").encode()) + [b"\n"]))
        seen = Counter(x for v in texts.values() for held, t in v if not held for x in t)
        total, base = sum(seen.values()), []
        for v in texts.values():
            base += [sum(math.log10((seen[x] + 0.1) / (total + 0.1 * (len(seen) + 1))) for x in t) for _, t in v]
        assert np.allclose(sorted(base), sorted(r["base_score"] for r in got))
        assert len(got) == rows.count() and all(r["train_tokens"] == total and math.isfinite(r["score"]) for r in got)
        assert all((r["held_out"], r["n_tokens"]) in [(h, len(t)) for h, t in texts[r["doc_id"]]] for r in got)
        if better:
            held = [r for r in got if r["held_out"]]
            assert sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)
    empty = docs.limit(0)
    counts = recurrent_lm.staged(spark, recurrent_lm.count_words(empty), "words")
    vocab = recurrent_lm.vocabulary(counts)
    w = recurrent_lm.train(empty, vocab)
    assert recurrent_lm.score(empty, w, vocab, counts).count() == 0
    assert {r["base_score"] for r in recurrent_lm.score(docs.filter("doc_id = 4"), w, vocab, counts).collect()} == {math.log10(0.1 / 0.1)}


def test_every_window_is_learned(spark):
    """Each word of a long text has a stretch of its own; all of them change."""
    key = next(i for i in range(99) if zlib.crc32(b"%d" % i) % 10)
    words = [f"w{i:02}" for i in range(40)]
    rows = spark.createDataFrame([(key, " ".join(w for w in words for _ in range(100)))], "doc_id bigint, text string").repartition(8)
    recurrent_lm.ship(spark)
    vocab = recurrent_lm.vocabulary(recurrent_lm.count_words(rows))
    first, w = recurrent_lm.first_weights(vocab), recurrent_lm.train(rows, vocab, rounds=1)
    moved = np.abs(w["E"] - first["E"]).max(axis=1)
    assert sorted(vocab.ids) == sorted(x.encode() for x in words)
    assert (moved[[*vocab.ids.values()]] > 0).all()


def test_training_tasks_follow_the_text(spark):
    """The learned weights do not thin out with the number of input partitions."""
    docs = table(spark, SF_SMALL, "documents")
    recurrent_lm.ship(spark)
    vocab = recurrent_lm.vocabulary(recurrent_lm.count_words(docs))
    first = recurrent_lm.first_weights(vocab)["U"]
    one, many = (np.abs(recurrent_lm.train(docs.repartition(n), vocab, rounds=1)["U"] - first).sum() for n in (1, 40))
    assert 0.7 < many / one < 1.4


@pytest.mark.parametrize("key", ["cast(null as bigint)", "7L"])
def test_rows_of_one_id_spread_over_blocks(spark, monkeypatch, key):
    """No task gets the rows of one doc_id, not even copies of one row."""
    monkeypatch.setattr(recurrent_lm, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", 1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for text in ("concat('some words and ', id)", "'the same words in all of the rows'"):
            rows = spark.range(0, 1200, 1, 40).selectExpr(f"{key} as doc_id", f"{text} as text", "'en' as lang")
            recurrent_lm.ship(spark)
            counts = recurrent_lm.staged(spark, recurrent_lm.count_words(rows), "words")
            vocab = recurrent_lm.vocabulary(counts)
            scores = recurrent_lm.score(rows, recurrent_lm.first_weights(vocab), vocab, counts)
            ids = spark.range(9).selectExpr("id as doc_id", "false as held_out")
            entropy = kneser_ney.cross_entropy(rows, kneser_ney.Model(kneser_ney.gram_counts(rows, ids).cache()))
            for out in (scores, entropy):
                sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
                assert sum(sizes) == 1200 and max(sizes) < 800
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_model(texts):
    """Interpolated modified Kneser-Ney over 4-gram numbers."""
    bits, order = kneser_ney.BITS, kneser_ney.ORDER
    grams = {order: Counter(g for t in texts for g in kneser_ney.grams_of(t).tolist())}
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g & ((1 << bits * k) - 1) for g in grams[k + 1])
    cut = {}
    for k, c in grams.items():
        n = [sum(1 for x in c.values() if x == i) for i in (1, 2, 3, 4)]
        cut[k] = (0.5, 1.0, 1.5)
        if all(n[:3]):
            y = n[0] / (n[0] + 2 * n[1])
            cut[k] = tuple(min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.1), i + 0.9) for i in range(3))
    after = {k: defaultdict(list) for k in grams}
    for k, c in grams.items():
        for g, n in c.items():
            after[k][g >> bits].append(n)

    def p(g):
        out = 1 / kneser_ney.ALPHABET
        for k in range(1, order + 1):
            own = g & ((1 << bits * k) - 1)
            seen = after[k].get(own >> bits)
            if seen:
                n = grams[k][own]
                out = (max(n - cut[k][min(n, 3) - 1], 0) * (n > 0) + sum(cut[k][min(x, 3) - 1] for x in seen) * out) / sum(seen)
        return out

    return p


def test_probabilities_equal_plain_kneser_ney(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log, the dog", "Éa ñu ??", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ids = spark.range(5).selectExpr("id as doc_id", "false as held_out")
    kneser_ney.ship(spark)
    model = kneser_ney.Model(kneser_ney.gram_counts(rows, ids).cache())
    p = plain_model(texts)
    asked = sorted({int(g) for t in [*texts, "a new text: the cod, ñ 漢 #1"] for g in kneser_ney.grams_of(t)})
    got = {r["g"]: r["lp"] for r in model.log_probs(spark.createDataFrame([(g,) for g in asked], "g bigint")).collect()}
    assert set(got) == set(asked)
    for g in asked:
        assert abs(got[g] - math.log(p(g))) < 1e-4
    start = asked[3] & ~(kneser_ney.ALPHABET - 1)
    assert abs(sum(p(start | c) for c in range(kneser_ney.ALPHABET)) - 1) < 1e-9


def test_an_order_is_derived_once(spark):
    """A job that reads all orders sums up the contexts only: the lower orders are there."""
    rows = spark.createDataFrame([(1, "some words of a text"), (2, "words of another one")], "doc_id bigint, text string")
    model = kneser_ney.Model(kneser_ney.gram_counts(rows, rows.select("doc_id", F.lit(False).alias("held_out"))))
    for k in range(1, kneser_ney.ORDER):
        assert "Aggregate" not in model.grams[k]._jdf.queryExecution().optimizedPlan().toString()


def test_decisions_equal_a_plain_version(spark):
    """Bounds from held-out trusted texts, per language, drawn towards the common ones."""
    rng = np.random.default_rng(9)
    words = ["ba", "lo", "mi", "ru", "ten", "sol"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 30))), ["en", "de", None][i % 3]) for i in range(240)]
    rows += [(500, "ba lo mi qqzzxx lo", "en"), (501, "ba lo mi qqzzxx lo", "xx"), (502, "", "de"), (503, None, "en"), (None, "ba lo", "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(i, 1, 1) for i in range(200, 220)], "doc_id bigint, quality int, toxic int")
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = {r["doc_id"]: r for r in kneser_ney.judged(df, labels).collect()}
    held = {r["doc_id"]: r["held_out"] for r in kneser_ney.trusted_ids(labels).collect()}
    assert set(held) == set(range(200))
    p = plain_model([t for i, t, _ in rows if held.get(i) is False])
    facts = {}
    for i, t, lang in rows:
        nats = [-math.log(p(g)) for g in kneser_ney.grams_of(t).tolist()]
        peak = max(sum(nats[k : k + kneser_ney.WINDOW]) for k in range(max(1, len(nats) - kneser_ney.WINDOW + 1)))
        facts[i] = (sum(nats), len(nats), peak - math.log(len(nats)), lang)
    at = lambda values, q: sorted(values)[max(0, math.ceil(q * len(values)) - 1)]

    def bounds(chosen):
        mu = at([facts[i][0] / facts[i][1] for i in chosen], 0.5)
        drawn = lambda i: (facts[i][0] + kneser_ney.PRIOR * mu) / (facts[i][1] + kneser_ney.PRIOR)
        return mu, at([drawn(i) for i in chosen], kneser_ney.QUANTILE), at([facts[i][2] for i in chosen], kneser_ney.QUANTILE)

    every = [i for i, h in held.items() if h]
    common = bounds(every)
    for i, (nats, n, peak, lang) in facts.items():
        mine = [j for j in every if facts[j][3] == lang and lang is not None]
        share = len(mine) / (len(mine) + kneser_ney.PRIOR_DOCS)
        mu, top, most = [share * o + (1 - share) * c for o, c in zip(bounds(mine) if mine else common, common)]
        r = out[i]
        assert abs(math.log(r["perplexity"]) - nats / n) < 1e-3 and abs(r["peak"] - peak) < 1e-2 and abs(r["peak_bound"] - most) < 1e-2
        level = (nats + kneser_ney.PRIOR * mu) / (n + kneser_ney.PRIOR)
        if min(abs(level - top), abs(peak - most)) > 1e-2:
            assert r["kept"] == (level <= top and peak <= most)
    assert not out[500]["kept"] and not out[501]["kept"]


def test_all_trusted_documents_make_the_model(spark):
    """No bound on the labelled documents: each is counted or held out."""
    n = 20_500
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    docs = spark.range(n).selectExpr("id as doc_id", "'ab' as text", "'en' as lang")
    ids = kneser_ney.trusted_ids(labels).cache()
    held = ids.filter("held_out").count()
    assert ids.count() == n and 0 < held < n // 2
    counts = {r["n"] for r in kneser_ney.gram_counts(docs, ids).collect()}
    assert counts == {n - held}
    ids.unpersist()


def test_letters_of_all_scripts_count(spark):
    """Junk in a script is told from its texts, whatever the script."""
    rng = np.random.default_rng(4)
    for letters in ("的一是不了人我在有他这", "αβγδεζηθικλ", "абвгдежзикл"):
        pairs = [letters[k] + letters[k + 1] for k in range(0, 10, 2)]
        text = lambda: " ".join("".join(rng.choice(pairs, 4)) for _ in range(20))
        junk = lambda: " ".join("".join(rng.choice(list(letters), 8)) for _ in range(20))
        rows = [(i, text(), "x") for i in range(120)] + [(200 + i, junk(), "x") for i in range(10)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id bigint, quality int, toxic int")
        kept = {r["doc_id"] for r in kneser_ney.keep_good(df, labels).collect()}
        assert not any(i >= 200 for i in kept) and len(kept) >= 110


def test_good_documents_stay_and_junk_and_abuse_go(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    kept = kneser_ney.keep_good(docs, labels)
    assert kept.columns == docs.columns
    # labelled toxic, and abusive words are in the text (other languages' texts have none)
    abusive = F.col("text").rlike("(?i)trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron")
    told = labels.join(docs, "doc_id").join(kept.select("doc_id").withColumn("k", F.lit(1)), "doc_id", "left")
    share = told.groupBy("quality", abusive.alias("abusive")).agg((F.count("k") / F.count(F.lit(1))).alias("s")).collect()
    share = {(r["quality"], r["abusive"]): r["s"] for r in share}
    assert share[1, False] > 0.97 and share[1, True] < 0.1 and share[0, False] < 0.15, share


def test_classifier_on_odd_rows(spark, docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in (0, 1, 2, 6, 7)] + [(9, 0, 0), (None, 1, 0), (0, 1, None)], "doc_id bigint, quality int, toxic int")
    assert kneser_ney.judged(docs, labels).count() == docs.count()
    kept = kneser_ney.keep_good(docs, labels.limit(0))
    assert kept.count() == docs.count() and kept.columns == docs.columns
    assert kneser_ney.keep_good(docs.limit(0), labels).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    seen, columns = docs, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.staged(spark, stage(spark, seen, SF_SMALL), f"test{i}")
        assert 0 < out.count() <= seen.count(), name
        assert out.columns[: len(columns)] == columns and out.select("doc_id").distinct().count() == out.count()
        seen = out
    assert seen.filter("token_ids is null or n_tokens != size(token_ids)").isEmpty()
    assert seen.filter("n_chars != length(text)").isEmpty()
    assert corpus_pipeline.run(spark, SF_SMALL).count() == seen.count()


def test_pipeline_stages_on_odd_rows(spark, docs, folder):
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.staged(spark, stage(spark, rows, str(folder)), "odd")
        assert set(docs.columns) <= set(rows.columns)


def test_words_and_groups_of_a_column_are_as_by_word():
    """Odd bytes, blanks and marks, in parts of a column; no word of its own is made."""
    rng = np.random.RandomState(5)
    letters = ["a", "B", "Z", ".", ",", "!", " ", "\t", "\x0b", "\x0c", "\r\n", "\x1c", "\x85", "\xa0", *"äöüßñíóúáèêçàâùîôÃé漢🙂"]
    texts = [None, b"", b"   ", b"\xc3", b"a\xc3 \xa4b \xc3 \xb1", b"\xff\xfe x", *("".join(rng.choice(letters, n)).encode() for n in rng.randint(0, 60, 300))]
    column = pa.array(texts, pa.binary())
    with pytest.MonkeyPatch.context() as patch:
        for size in (1 << 20, 40):
            patch.setattr(recurrent_lm, "SPLIT_BYTES", size)
            for c, some in ((column, texts), (column.slice(4, 200), texts[4:204]), (pa.chunked_array([column, column]), texts * 2)):
                parts = list(recurrent_lm.split_words(c))
                words = [w for _, flat in parts for w in flat.to_pylist()]
                assert words == [w for t in some for w in recurrent_lm.words_of(t)]
                assert [n for sizes, _ in parts for n in sizes.tolist()] == [len(recurrent_lm.words_of(t)) for t in some]
                assert [g for _, flat in parts for g in recurrent_lm.groups_of(flat).tolist()] == [plain_group(w) for w in words]
    assert not len(recurrent_lm.groups_of(pa.array([], pa.binary())))


def plain_group(word):
    end = {ord("."): 1, ord(","): 2, ord("!"): 3, ord("?"): 3}.get(word[-1], 0)
    n = len(word) - (end > 0)
    mark = 0 if word.isascii() else next((k + 1 for k, m in enumerate(recurrent_lm._MARKS) if any(m[i : i + 2] in word for i in range(0, len(m), 2))), 4)
    return (end * 5 + mark) * 3 + (0 if n <= 4 else 1 if n <= 9 else 2)
