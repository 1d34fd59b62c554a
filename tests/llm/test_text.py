"""Decontamination, BPE, page text against plain versions and the library."""

import hashlib
import math
import random
import resource
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import bpe, common, decontamination, site_tree


def plain_hits(words, items, window=13):
    """Hit positions and the names of items with an occurring window."""
    hit, found = set(), set()
    for name, item in items:
        n = min(window, len(item))
        grams = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(name)
    return hit, found


letters = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30)


@settings(max_examples=150, deadline=None)
@given(letters, st.lists(letters, max_size=4), st.integers(1, 5))
def test_automaton_equals_plain_windows(words, items, window):
    named = [(str(i), x) for i, x in enumerate(items)]
    hit, found = decontamination.Automaton(named, window).scan(words)
    assert (set(np.flatnonzero(hit).tolist()), found) == plain_hits(words, named, window)


@settings(max_examples=60, deadline=None)
@given(letters, st.lists(letters, max_size=4), st.integers(1, 5), st.integers(1, 8))
def test_written_automaton_of_pieces(words, items, window, most):
    """Pieces of items have all their windows; what a table holds of an automaton is all of it."""
    pieces = [(str(i), p) for i, x in enumerate(items) if x for p in decontamination.pieces_of(x, window, most)]
    assert all(len(p) <= max(most, window) for _, p in pieces)
    read = decontamination.Automaton.load(decontamination.Automaton(pieces, window).row())
    hit, found = read.scan(words)
    assert (set(np.flatnonzero(hit).tolist()), found) == plain_hits(words, [(str(i), x) for i, x in enumerate(items)], window)


def test_long_matches_and_common_words_stay_linear():
    """States a word stay few, edges are found in order, a document that holds
    a whole long item of few words is streamed once."""
    same, rng = [b"x"] * 30_000, random.Random(5)
    mixed = [rng.choice([b"the", b"of", b"a", b"to"]) for _ in range(30_000)]
    made = decontamination.Automaton([("same", same), ("mixed", mixed), ("short", [b"x", b"x"])])
    assert len(made.parts["link"]) <= 2 * 60_003 and len(made.parts["edge_to"]) <= 3 * 60_003
    hit, found = made.scan(same + [b"other"] + mixed[100:20_000] + [b"x"])
    assert found == {"same", "mixed", "short"} and np.flatnonzero(~hit).tolist() == [30_000, 49_901]


ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def bench(spark):
    rows = [(1, ITEM), (2, "Short item, of six words!"), (3, None), (4, "..."), (None, "nameless item text"), (1, ITEM + " sixteen"), (5, "lazy dog and runs far")]
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "1 as name", "2 as doc_id")


def with_items(docs):
    rows = [
        (20, "x " * 50 + ITEM.upper() + " y" * 50, "en"), (21, "intro " + ITEM[4:] + "; end", "en"), (22, "short item of six words", None),
        (23, "nothing " * 400 + "short item of SIX words", "en"), (24, "fourteen fifteen sixteen", "en"), (25, "nameless-item/text", "en"),
    ]
    more = docs.sparkSession.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return docs.unionByName(more, allowMissingColumns=True)


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_hits_of_odd_rows(spark, docs, block):
    rows = with_items(docs)
    named = [(str(r["item_id"]) if r["item_id"] is not None else "null", decontamination.words_of((r["text"] or "").encode())) for r in bench(spark).collect()]
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontamination.scan(rows, bench(spark), block_bytes=block).collect()), key=str)
    want = []
    for r in rows.collect():
        words = decontamination.words_of((r["text"] or "").encode())
        hit, found = plain_hits(words, named)
        want.append((r["doc_id"], len(words), len(hit), tuple(sorted(found))))
    assert got == sorted(want, key=str)


def test_contaminated_documents_go_and_spans_are_cut(spark, docs):
    rows = with_items(docs)
    bad = {r["doc_id"] for r in decontamination.scan(rows, bench(spark)).filter(decontamination.contaminated()).collect()}
    out = decontamination.decontaminate(rows, bench(spark), max_span=5).collect()
    blocks = decontamination.decontaminate(rows, bench(spark), max_span=5, block_bytes=20)
    assert blocks.columns == rows.columns and sorted(map(str, blocks.collect())) == sorted(map(str, out))
    assert decontamination.decontaminate(rows, bench(spark), block_bytes=20).count() == len(out)
    assert decontamination.decontaminate(rows, bench(spark), coverage=None, block_bytes=20).count() == rows.count()
    assert {20, 21, 22, 25} <= bad and 23 not in bad
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r["doc_id"]) for r in rows.collect() if r["doc_id"] not in bad)
    text = {r["doc_id"]: r["text"] for r in out}
    assert text[23] == "nothing " * 400 and text[3] is None
    none = decontamination.decontaminate(rows, bench(spark).limit(0))
    assert none.count() == rows.count() and none.columns == rows.columns
    assert decontamination.scan(docs.limit(0), bench(spark)).count() == 0


def test_blocks_are_bounded_and_built_by_tasks(spark):
    rows = [(i, f"item {i} " + " ".join(f"w{(i * 7 + k) % 50}" for k in range(40))) for i in range(30)] + [(99, ITEM)] * 50
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    made = decontamination.automata(items, block_bytes=1000).selectExpr("block", "length(words) as words", "length(link) / 4 as states").collect()
    assert len(made) > 5 and len({r["block"] for r in made}) == len(made) and all(r["states"] <= 1001 for r in made)
    found = decontamination.scan(spark.createDataFrame([(1, ITEM)], "doc_id bigint, text string"), items, block_bytes=1000).collect()
    assert [(r["n_hit"], r["items"]) for r in found] == [(15, ["99"])]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_vocabulary(bpe.vocabulary_path()))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


ODD = "ab  eE'stdl\n\t \x85\xa0\x1c\x0b<|endoftext|>0½é漢🙂‍́ß_#-"


@settings(max_examples=120, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=ODD, max_size=40)), st.booleans())
def test_codec_equals_library(codec, library, text, special):
    text = text.encode("utf-8", "replace").decode() + ("<|endoftext|> tail" if special else "")
    got = next(codec.encode_batch([text]))
    assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(got) == text


def test_long_words_and_a_small_cache(codec, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeé") for _ in range(n)) for n in (63, 64, 65, 500, 20_000)] + ["a" * 5000, " " * 3000 + "x", "\n" * 2000]
    small = bpe.Codec(bpe.load_vocabulary(bpe.vocabulary_path()), cache_words=1)
    for t, a, b in zip(texts, codec.encode_batch(texts), small.encode_batch(texts)):
        assert a == b and np.frombuffer(a, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_encoded_rows(docs, library):
    rows = docs.withColumn("n_tokens", docs["at"])
    coded = bpe.encode(rows)
    assert set(rows.columns) <= set(coded.columns)
    back = bpe.decode(coded).collect()
    assert len(back) == rows.count()
    for r in back:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == want and r["n_tokens"] == len(want) and r["decoded"] == (r["text"] or "") and r["_text"] == "t"
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.encode(docs.limit(0)).count() == 0


PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Home<li>More</ul></nav><div id="cookie-notice">We use cookies</div>
<main><article><header><h1>A &lt;b&gt; &eacute;&#33;</h1></header><p>First <b>bold<br>line<p>Second&nbsp; one <!-- <p>no -->
<script>var a = "</p><p>no"</script><ul><li>x<li>y <i>z</i></ul><div class="ad-box ads">buy</div><form>name <input></form>
<table><tr><td>1<td>2</table><p title="a > b">Third</article><section class="comments"><article>me too</article></section></main>
<aside>side</aside><footer>&copy; foot</footer>"""


def test_page_text():
    assert site_tree.main_text(PAGE, ()) == "A <b> é!\nFirst bold line\nSecond one\nx\ny z\n1\n2\nThird"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b", "a\nb"), ("<p>a<!-- never closed <p>b", "a"), ("<p>a<script>x", "a"),
        ("<div class='sidebar'><article>kept</article></div>", "kept"), ("<nav>menu</nav><div>text</div>", "text"), ("<p>5 < 6 and 7 > 3</p>", "5 < 6 and 7 > 3"),
        ("<body><p>x<p", "x"), ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_odd_pages(page, text):
    assert site_tree.main_text(page, ()) == text


def test_text_outside_teasers_stays():
    page = "<div><p>the text</p></div><aside><article>teaser</article></aside><div class='related'><article>other</article></div>"
    assert site_tree.main_text(page, ()) == "the text"


@pytest.mark.parametrize(
    "page,text",
    [
        ('<div class="layout with-sidebar"><p>the text</p></div>', "the text"),
        ('<body class="x"><div class="content-social-science"><p>one</p><nav>menu</nav><p>two</p></div></body>', "one\ntwo"),
        ('<div class="sidebar">links</div><p>the text</p>', "the text"),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_a_class_word_does_not_take_all_of_the_text(page, text):
    assert site_tree.main_text(page, ()) == text


def site(n=12):
    """A site without helpful names: one changing and two fixed branches."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rng = random.Random(5)
    rows = []
    for i in range(n):
        body = "".join(f"<p>{' '.join(rng.choice(words) for _ in range(9))} {i}</p>" for _ in range(rng.randint(2, 6)))
        rows.append((i, f"http://x.example/{i}", f"<body><div class=qa><p>Same box</p></div><div class=qb>{body}</div><div class=qc><p>All rights</p></div>"))
    return rows


def plain_tree(rows):
    """(host, branch) -> (pages, importance), by the docstring's formula over plain dictionaries."""
    kids, texts, below = {}, {}, {}
    for host, page in {(site_tree.host_of(url), html or "") for _, url, html in rows}:
        for node, text in site_tree.parse(page)[0]:
            chain = site_tree.around(node)
            for b in chain:
                kids.setdefault((host, b.key), set()).add((" ".join(b.kids), page))
                below.setdefault((host, b.key), set()).add(chain[0].key)
            if chain:
                texts.setdefault((host, chain[0].key), set()).add((text, page))

    def spread(seen):
        counts = list(Counter(value for value, _ in seen).values())
        n = sum(counts)
        return (-sum(c / n * math.log(c / n) for c in counts) / math.log(n) if n > 1 else 1.0), n, len(counts)

    out = {}
    for (host, key), seen in kids.items():
        shape, n, kinds = spread(seen)
        parts = [spread(texts[host, k])[:2] for k in below[host, key]]
        content = sum(e * m for e, m in parts) / sum(m for _, m in parts)
        out[host, site_tree._signed(key)] = (n, (1 - site_tree.DECAY**kinds) * shape + site_tree.DECAY**kinds * content)
    return out


def test_importance_equals_the_plain_formula(spark):
    deep = [(50 + i, "http://y.example/p", f"<body><div class=a><div class=b>{'<p>x</p>' * (i % 3)}<p>t{i % 4}</p></div>tail</div><div id=c>{i}</div>") for i in range(7)]
    rows = site() + deep + [(60, "http://y.example/q", PAGE), (61, None, PAGE), (62, None, None), (63, "http://y.example/p", deep[0][2])]
    got = site_tree.style_tree(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    want = plain_tree(rows)
    assert {(r["host"], r["branch"]): r["pages"] for r in got} == {k: n for k, (n, _) in want.items()}
    for r in got:
        assert r["importance"] == pytest.approx(want[r["host"], r["branch"]][1], abs=1e-9)


@pytest.mark.parametrize("sent", [1000, 0])
def test_branches_alike_on_every_page_go(spark, sent):
    rows = site() + [(100, "http://other.example/", site(1)[0][2]), (None, None, None), (101, None, ""), (3, "http://x.example/3", site()[3][2])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as host", "2 as branch", "3 as page")
    got = site_tree.extract(df, sent_rows=sent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["url"] and "x.example" in r["url"]:
            assert r["text"] and "Same box" not in r["text"] and "All rights" not in r["text"]
        elif r["page_id"] == 100:
            assert r["text"].startswith("Same box") and r["text"].endswith("All rights")
        else:
            assert r["text"] == ""
    assert site_tree.extract(df.limit(0)).count() == 0


def test_what_a_worker_lets_go_of_goes_back_to_the_machine():
    last = []

    def build():
        rows = [b"x" * (2000 + i % 7) for i in range(100_000)]
        last.append(rows[-1])  # what stays lies above what is let go of
        return rows

    common.drop_held()
    common.held("large", build)
    before = resident_mb()
    common.drop_held()
    assert before - resident_mb() > 150


def resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * resource.getpagesize() / 1e6


@pytest.mark.parametrize("at_once", [1, 40, 10_000])
def test_slices_are_all_rows_in_order(at_once):
    texts = ["a" * 30, None, "", "é" * 100, *["b"] * 50, None]
    batch = pa.record_batch({"k": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    got = list(common.in_slices(iter([batch, batch.slice(0, 0), batch.slice(2)]), "text", at_once))
    rows = [(r["k"], r["text"]) for b in got for r in b.to_pylist()]
    assert rows == [*enumerate(texts), *list(enumerate(texts))[2:]]
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column("text").to_pylist()[1:]) <= at_once for b in got)
