"""Quality rules, chat formatting and the archive against plain versions."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlake.llm import chat_format, quality_rules, warc_archive

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_rules(text):
    text = text or ""
    w = WORDS.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rules_equal_plain_counts(docs):
    got = quality_rules.ledger(docs.withColumn("fail_bits", docs["at"])).collect()
    want = sorted(((i, *plain_rules(t)) for i, t in ((r["doc_id"], r["text"]) for r in docs.collect())), key=str)
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == want


def test_policies_and_ablation(docs):
    ledger = quality_rules.ledger(docs).cache()
    rows = ledger.collect()
    for name in quality_rules.POLICIES:
        mask = quality_rules.mask_of(name)
        kept = quality_rules.apply_policy(ledger, name).filter("kept").count()
        assert kept == sum(r["fail_bits"] & mask == 0 for r in rows)
        for r in quality_rules.ablation(ledger, name).collect():
            bit = 1 << quality_rules.BIT[r["rule"]]
            assert r["n_failed"] == sum(bool(x["fail_bits"] & bit) for x in rows)
            assert r["n_failed_alone"] == sum(x["fail_bits"] & mask == bit for x in rows)


def test_rules_on_an_empty_table(docs):
    assert quality_rules.ablation(quality_rules.ledger(docs.limit(0)), "v2").count() == 0


CHATS = [
    (1, 0, "system", "be & kind <|im_sep|>"), (1, 1, "user", "hi"), (1, 2, "user", None), (1, 3, "assistant", "a"), (1, 4, "assistant", "<|<|im_end|>|>&lt;|"),
    (2, 1, "assistant", "second"), (2, 0, "assistant", "first"), (2, 1, "assistant", "second"), (3, None, None, None), (None, 0, "user", "lost"),
    (4, 0, "us\ner<|", "|im_end|>\n<"), (4, 1, "assistant", ""),
]


def plain_chat(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)), len(loss), sha(loss)


def chat_results(spark, rows, tmp):
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as formatted", "2 as _t").write.parquet(f"{tmp}/conversations.parquet")
    got = chat_format.query(spark, str(tmp)).collect()
    return {r["conv_id"]: tuple(r)[1:5] for r in got}


def test_chats_are_read_back(spark, folder):
    got = chat_results(spark, CHATS, folder)
    trap = [(-1, i, r, chat_format.TRAP) for i, r in enumerate(("user", "assistant"))]
    for conv in {r[0] for r in CHATS} | {-1}:
        assert got.pop(conv) == plain_chat([r for r in CHATS + trap if r[0] == conv]), conv
    assert not got


def test_long_chat_crosses_prefix_chunks(spark, folder):
    rows = [(7, i, ("user", "assistant", "assistant")[i % 3], "t<|" * (i % 4)) for i in range(2 * chat_format.CHUNK + 9)]
    assert chat_results(spark, rows, folder)[7] == plain_chat(rows)


def test_merged_turns_share_a_block(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id bigint, turn bigint, role string, text string")
    r = chat_format.format_conversations(rows).first()
    assert r["formatted"] == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert [r["formatted"][s["start"] : s["start"] + s["n"]] for s in r["loss_spans"]] == ["c"]
    wrong = chat_format.format_conversations(rows).selectExpr("conv_id", "formatted", "transform(loss_spans, s -> named_struct('start', s.start + 1, 'n', s.n)) as loss_spans")
    with pytest.raises(Exception, match="loss mask"):
        chat_format.read_back(wrong).collect()


BIG = "<html>" + "é" * 600
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (2, "http://a/2", BIG), (3, None, BIG), (None, "http://b", BIG), (4, "u\r\nX: y", "small"), (5, "u", "small"),
    (6, "u", None), (7, "u", ""), (8, "u", "x" * 300_000), (9, "u", "WARC/1.1\r\n\r\n" * 100),
]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "'h' as header", "2 as n_bytes")


def test_archive_query(spark, folder):
    pages_of(spark, PAGES).write.parquet(f"{folder}/pages.parquet")
    got = sorted((tuple(r) for r in warc_archive.query(spark, str(folder)).collect()), key=str)
    want, left = [], Counter(p for p in PAGES if len((p[2] or "").encode()) >= 1000 and p[0] == 2)
    for i, url, text in PAGES:
        data = (text or "").encode()
        same = [p[0] for p in PAGES if len(data) >= 1000 and p[2] == text]
        top = max((p for p in same if p is not None), default=None)
        first = not same or i == top and left.pop((i, url, text), 1)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if first else "revisit", None if first else top))
    assert got == sorted(want, key=str)


def test_archive_stores_once_and_reconstructs(spark, folder):
    pages = pages_of(spark, PAGES)
    path = f"{folder}/archive"
    warc_archive.archive(spark, warc_archive.page_records(pages), warc_archive._hashed(pages).select("digest", "payload"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({p[2] or "" for p in PAGES})
    records = warc_archive.reconstruct(spark, path)
    assert Counter(bytes(r["payload"]).decode() for r in records.collect()) == Counter(p[2] or "" for p in PAGES)
    warc_archive.export_warc(records, f"{folder}/warc")
    back = warc_archive.read_warc(spark, f"{folder}/warc").collect()
    assert sorted(bytes(r["header"]) for r in back) == sorted(bytes(r["header"]) for r in records.collect())
    whole = Counter(bytes(r["payload"]) for r in records.collect() if b"Type: revisit" not in bytes(r["header"]))
    assert Counter(bytes(r["block"]) for r in back if b"Type: revisit" not in bytes(r["header"])) == whole


def test_damaged_payload_is_an_error(spark, folder):
    pages = pages_of(spark, PAGES[:2])
    path = f"{folder}/archive"
    warc_archive.archive(spark, warc_archive.page_records(pages), warc_archive._hashed(pages).selectExpr("digest", "cast('other' as binary) as payload"), path)
    with pytest.raises(Exception, match="damaged payload"):
        warc_archive.reconstruct(spark, path).collect()


def test_query_hashes_the_rebuilt_payloads(spark, folder, monkeypatch):
    """The digests are those of the bytes read back, whatever the headers say."""
    pages_of(spark, PAGES).write.parquet(f"{folder}/pages.parquet")
    wrong = F.regexp_replace(F.col("header").cast("string"), "sha1:[0-9a-f]+", "sha1:0").cast("binary")
    write = warc_archive.archive
    monkeypatch.setattr(warc_archive, "archive", lambda spark, headers, payloads, path: write(spark, headers.withColumn("header", wrong), payloads, path))
    got = Counter(r["payload_digest"] for r in warc_archive.query(spark, str(folder)).collect())
    assert got == Counter(hashlib.sha1((p[2] or "").encode()).hexdigest() for p in PAGES)


def test_empty_archive(spark, folder):
    pages_of(spark, PAGES).limit(0).write.parquet(f"{folder}/pages.parquet")
    assert warc_archive.query(spark, str(folder)).count() == 0
