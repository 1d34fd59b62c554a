"""Main text of web pages with a site style tree.

Pages of one host are merged by element path (tag, class and id with digits
folded) into one tree. Every branch gets an importance from two entropies over
the host's distinct pages: of its child sequences (presentation) and of the
texts below it (content: the mean over the elements below, by their texts),
each divided by its maximum, so a branch that looks or reads the same
everywhere is near 0:

    importance = (1 - g^l) * presentation + g^l * content

with l the number of child sequences seen. Branches below ``LEAST`` are
removed from the host's pages, but in an article or main element only those
with a class or id of their own, so that an article that many pages share
stays whole. Elements whose name, class or id states that they are no article
(``NOISE_TAGS``, ``NOISE_WORDS``) are removed on any host, as one page of a
site has no entropy.

Text: character references are decoded, white space inside a block becomes
one blank, empty blocks go, blocks are joined in page order by line feeds.

Defined results: a null or empty page has the empty text; unclosed elements,
comments and scripts run to where HTML ends them or to the page's end; a null
url belongs to a host without a name; repeated rows get equal results and
equal pages count once in a tree; extra columns are ignored; an empty table
gives no rows. Parsing is linear in the page.

Scale: pages are not shuffled. Entropies are sums over (host, branch), reduced
per task, so a host with a third of all pages is no hot key. The removed
branches reach the tasks by broadcast while there are at most ``SENT_ROWS``,
beyond that by a join with the branches of each page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import ship, staged, table

LEAST = 0.3
DECAY = 0.9
MIN_PAGES = 5
#: Levels of a page that are branches of their own.
DEPTH = 64
SENT_ROWS = 50_000

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("hr".split())
RAW_TAGS = frozenset("script style noscript template textarea iframe svg math object xmp noembed noframes title".split())
NOISE_TAGS = frozenset("aside dialog fieldset footer form head menu nav optgroup option select".split())
NOISE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertisements advertising alert alerts banner banners breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies copyright discussion disqus feedback footer gdpr "
    "login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar sidebars "
    "signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Noise only outside an article, whose own heading may stand in it.
PAGE_WORDS = frozenset("header".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: Elements an opening tag ends when one of them is open: the innermost of the
#: first, unless one of the second stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(r"""<(?:!--(?:.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[!?/][^>]*>)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "up", "key", "noise", "root", "named", "kids", "depth", "anchor")

    def __init__(self, tag: str, label: str, words: frozenset[str], up: Node | None):
        self.tag, self.up = tag, up
        self.key = xxhash.xxh64_intdigest(f"{up.key if up else 0}/{label}")
        inside = up is not None and up.root is not None
        own = tag in NOISE_TAGS or not words.isdisjoint(NOISE_WORDS)
        own = own or (not inside and (tag == "header" or not words.isdisjoint(PAGE_WORDS)))
        #: The outermost article element above, or this one.
        self.root = up.root if inside else self if tag in ("article", "main") or "main" in words and label.startswith(("div", "section")) else None
        self.noise = (own and tag not in ("html", "body", "main")) or (up.noise if up else False)
        self.depth = up.depth + 1 if up else 0
        #: Deeper elements belong to the branch of the last one that counts.
        self.anchor = self if self.depth <= DEPTH else up.anchor
        self.named = "." in label or "#" in label
        self.kids: list[str] = []


def parse(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """Text blocks with their elements, in page order, and all block elements."""
    top = Node("html", "html", frozenset(), None)
    at, node, blocks, nodes, text = 0, top, [], [], []

    def flush() -> None:
        if text:
            words = entities.unescape("".join(text)).split()
            if words:
                blocks.append((node, " ".join(words)))
            text.clear()

    find = _TAG.search
    while (m := find(page, at)) is not None:
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW_TAGS:
            if not closing and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag not in BLOCK_TAGS:
            if tag == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            up = node
            while up is not None and up.tag != tag:
                up = up.up
            if up is not None and up.up is not None:
                node = up.up
            continue
        if node.tag == "p" or (node.tag[0] == "h" and node.tag[1:].isdigit() and tag[0] == "h" and tag[1:].isdigit()):
            node = node.up
        if tag in ENDS:
            ended, stop = ENDS[tag]
            up = node
            while up.up is not None and up.tag not in ended and up.tag not in stop:
                up = up.up
            if up.tag in ended:
                node = up.up
        if tag in ("html", "body") and node.tag in ("html", "body") and not (tag == "body" and node.tag == "html"):
            continue
        attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(m[3])} if m[3] else {}
        names = " ".join(attrs.get(k, "") for k in ("class", "id", "role", "itemprop"))
        words = frozenset(x.lower() for x in _PARTS.findall(names))
        label = tag
        if attrs.get("class"):
            label += "." + ".".join(sorted(set(attrs["class"].split())))
        if attrs.get("id"):
            label += "#" + attrs["id"]
        label = _DIGITS.sub("0", label)
        node.kids.append(label)
        new = Node(tag, label, words, node)
        if tag not in VOID_TAGS:
            node = new
            nodes.append(new)
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag the page ends in
        text.append(rest[: cut.start()] if cut else rest)
    flush()
    return blocks, nodes


def article(blocks: list[tuple[Node, str]], nodes: list[Node]) -> tuple[list[tuple[Node, str]], bool]:
    """The blocks that belong to an article by the page's own marks, and
    whether it has such marks. Without an article element outside noise, the
    body without noise; only if that has no text, the articles in noise, and
    without these what is outside noise by element: a class word does not take all
    of a page's text."""
    roots = [n for n in nodes if n.root is n]
    good = {id(n) for n in roots if not n.noise}
    if good:
        return [(n, t) for n, t in blocks if n.root is not None and id(n.root) in good and not n.noise], True
    plain = [(n, t) for n, t in blocks if not n.noise]
    if roots and not plain:  # all text stands in elements named as noise: the names above an article don't count
        return [(n, t) for n, t in blocks if n.root is not None and not _noise_below(n, n.root)], True
    if not plain:
        return [(n, t) for n, t in blocks if not _noise_below(n, None)], False
    return plain, False


def _noise_below(node: Node | None, root: Node | None) -> bool:
    while node is not root:
        if node.tag in NOISE_TAGS:
            return True
        node = node.up
    return False


def branches(node: Node, marked: bool) -> Iterator[Node]:
    """The elements around a block that may be removed for low importance."""
    node = node.anchor
    while node is not None and node.up is not None and node.tag != "body" and not (marked and node is node.root):
        if not marked or node.named:
            yield node
        node = node.up


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def around(node: Node) -> list[Node]:
    """The branches that a block's element is in, itself first, below the body."""
    out, node = [], node.anchor
    while node.up is not None and node.tag != "body":
        out.append(node)
        node = node.up
    return out


#: Kinds of rows: a child sequence, a text, a branch above.
_KIDS, _TEXT, _ABOVE = 0, 1, 2


def site_rows(pages: DataFrame) -> DataFrame:
    """(host, branch, kind, value, page) of every element with text, as hashes:
    its child sequence, the texts that stand directly in it, and the branches
    above it (these are the same on every page, ``page`` is 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple] = set()
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html")):
                page = page.as_py() or ""
                host, own = host_of(url), _signed(xxhash.xxh64_intdigest(page))
                done: set[int] = set()
                for node, text in parse(page)[0]:
                    chain = around(node)
                    if not chain:
                        continue
                    key = _signed(chain[0].key)
                    rows.add((host, key, _TEXT, _signed(xxhash.xxh64_intdigest(text)), own))
                    if (host, key, _ABOVE, key, 0) not in rows:
                        rows |= {(host, key, _ABOVE, _signed(b.key), 0) for b in chain}
                    for b in chain:
                        if id(b) in done:
                            break  # what is above has been seen with it
                        done.add(id(b))
                        rows.add((host, _signed(b.key), _KIDS, _signed(xxhash.xxh64_intdigest(" ".join(b.kids))), own))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "branch", "kind", "value", "page"])

    return pages.select("url", "html").mapInArrow(run, "host string, branch bigint, kind int, value bigint, page bigint")


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, branch, pages, importance) of every branch of every host."""
    values = site_rows(pages).distinct().groupBy("host", "branch", "kind", "value").agg(F.count(F.lit(1)).alias("c"))
    c = F.col("c").cast("double")
    counts = values.filter(F.col("kind") != _ABOVE).groupBy("host", "branch", "kind").agg(F.sum(c).alias("n"), F.sum(c * F.log(c)).alias("s"), F.count(F.lit(1)).alias("v"))
    # entropy over its maximum; one row alone has nothing to compare with
    spread = F.when(F.col("n") > 1, (F.log("n") - F.col("s") / F.col("n")) / F.log("n")).otherwise(1.0)
    spreads = counts.select("host", "branch", "kind", "n", "v", spread.alias("e"))
    texts = spreads.filter(F.col("kind") == _TEXT).select("host", "branch", "n", "e")
    above = values.filter(F.col("kind") == _ABOVE).select("host", "branch", F.col("value").alias("top"))
    content = texts.join(above, ["host", "branch"]).groupBy("host", F.col("top").alias("branch")).agg((F.sum(F.col("n") * F.col("e")) / F.sum("n")).alias("content"))
    kids = spreads.filter(F.col("kind") == _KIDS).select("host", "branch", F.col("n").alias("pages"), F.col("e").alias("presentation"), F.pow(F.lit(DECAY), F.col("v")).alias("w"))
    tree = kids.join(content, ["host", "branch"])
    return tree.select("host", "branch", "pages", ((1 - F.col("w")) * F.col("presentation") + F.col("w") * F.col("content")).alias("importance"))


def unimportant(pages: DataFrame, least: float = LEAST, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, branch) of the branches whose importance is below ``least``."""
    return style_tree(pages).filter((F.col("pages") >= min_pages) & (F.col("importance") < least)).select("host", "branch")


def page_branches(pages: DataFrame) -> DataFrame:
    """(page_id, url, page, host, branch): the branches of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hosts, found = [], [], []
            for i, (url, page) in enumerate(zip(batch.column("url").to_pylist(), batch.column("html"))):
                blocks, marked = article(*parse(page.as_py() or ""))
                own = {_signed(b.key) for node, _ in blocks for b in branches(node, marked)}
                keys.extend([i] * len(own))
                hosts.extend([host_of(url)] * len(own))
                found.extend(own)
            at = pa.array(keys, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_key").take(at), pa.array(hosts, pa.string()), pa.array(found, pa.int64())], ["_key", "host", "branch"])

    return pages.select("_key", "url", "html").mapInArrow(run, "_key bigint, host string, branch bigint")


def main_text(page: str | None, low) -> str:
    """The text of a page without the branches ``low``."""
    blocks, marked = article(*parse(page or ""))
    return "\n".join(t for n, t in blocks if not low or all(_signed(b.key) not in low for b in branches(n, marked)))


def extract(pages: DataFrame, sent_rows: int = SENT_ROWS) -> DataFrame:
    """(page_id, url, text) per row of (page_id, url, html)."""
    spark = ship(pages.sparkSession)
    low = staged(spark, unimportant(pages), "branches")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    if low.count() <= sent_rows:
        by_host: dict[str, set[int]] = {}
        for r in low.collect():
            by_host.setdefault(r["host"], set()).add(r["branch"])
        sent = spark.sparkContext.broadcast(by_host)
        lows = lambda batch: [sent.value.get(host_of(u), ()) for u in batch.column("url").to_pylist()]
    else:
        rows = rows.withColumn("_key", F.xxhash64("url", "html"))
        own = page_branches(rows).distinct().join(low, ["host", "branch"], "left_semi").groupBy("_key").agg(F.collect_set("branch").alias("_low"))
        rows = rows.join(own, "_key", "left").select("page_id", "url", "html", "_low")
        lows = lambda batch: [set(x or ()) for x in batch.column("_low").to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), x) for p, x in zip(batch.column("html"), lows(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
