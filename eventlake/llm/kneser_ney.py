"""Quality classifier: interpolated modified Kneser-Ney character model.

Training: a character is a 16-bit symbol, so a 4-gram is one 64-bit number; all
scripts keep their letters (digits are one symbol, blanks one, characters beyond
U+FFFF share the 6,400 symbols of the private-use area). The 4-grams of all
trusted texts (labels: good and not toxic) but those held out are counted;
continuation counts, context totals, counts of counts and the three discounts of
every order are aggregations of that table.

Scoring: documents are dealt into blocks. A block asks for its distinct
4-grams; the asked grams are joined with the count tables of every order and
their contexts, sharded by gram, which gives each its interpolated
probability; a block gets back its own grams and scores whole texts: the cross
entropy, and the largest surprise of ``WINDOW`` characters in a row.

Decision: per language, quantiles of the trusted documents that were held out of
training (one in ``CALIBRATION_SHARE``, by hash) bound both. A text that is ordinary as a whole is rejected for one
passage such as no trusted text has. The mean of a short text is drawn
towards the language's median, as if ``PRIOR`` typical characters stood before
it; the largest surprise grows with the logarithm of a text's length, and is
compared after taking off what that adds. A language's bounds are drawn
towards those of all languages together, as if ``PRIOR_DOCS`` documents of the
common kind were among its held-out ones.

Defined results: a null or empty text has one symbol (its end) and is judged
alike; a null language uses the common bounds; rows with a null doc_id are
never trusted; repeated rows are scored each; a very long text is one row of one
block (about 30 bytes are held a character); extra columns are kept by
``keep_good``; without labels nothing is rejected; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import block_count, distinct, drop_held, release, row_block, ship, staged, table

ORDER = 4
BITS = 16
#: Of the trusted documents, one in so many is held out for the quantiles.
CALIBRATION_SHARE = 5
QUANTILE = 0.995
PRIOR, PRIOR_DOCS = 60.0, 20.0
#: Characters whose surprise is added up.
WINDOW = 8
BLOCK_BYTES = 16 << 20
CHUNK = 2_000_000
#: Symbols of the uniform distribution under the first order.
ALPHABET = 1 << BITS

_SYMBOLS: list[np.ndarray] = []


def symbols() -> np.ndarray:
    """Symbol of every code point below U+10000; 0 is the text's edge."""
    if not _SYMBOLS:
        out = np.arange(0x10000, dtype=np.int64)
        for c in range(0x10000):
            kind = unicodedata.category(chr(c))
            if kind == "Nd":
                out[c] = ord("0")
            elif kind[0] == "Z" or kind == "Cc":
                out[c] = ord(" ")
        out[[10, 13]] = 10
        _SYMBOLS.append(out)
    return _SYMBOLS[0]


def grams_of(text: str | None) -> np.ndarray:
    """The 4-gram that ends at each character and at the text's end."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    c = np.zeros(len(raw) + ORDER, np.int64)
    c[ORDER - 1 : -1] = symbols()[np.where(raw < 0x10000, raw, 0xE000 + raw % 6400)]
    out = c[: len(raw) + 1]
    for i in range(1, ORDER):
        out = (out << BITS) | c[i : i + len(raw) + 1]
    return out


def low_order(g: Column, k: int) -> Column:
    """The last ``k`` symbols of a 4-gram."""
    return g.bitwiseAND(F.lit((1 << BITS * k) - 1).cast("long")) if k < ORDER else g


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, held_out) of all trusted documents."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).filter("q = 1 and coalesce(t, 0) = 0 and doc_id is not null")
    return good.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION_SHARE)) == 0)


def gram_counts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(g, n) over the trusted texts that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text")).join(ids.filter("not held_out").select("doc_id"), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            g, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(n, pa.int64())], ["g", "n"])

        drop_held()
        parts, size = [], 0
        for batch in batches:
            for text in batch.column("_text"):
                parts.append(grams_of(text.as_py()))
                size += len(parts[-1])
                if size >= CHUNK:
                    yield counted(parts)
                    parts, size = [], 0
        if parts:
            yield counted(parts)

    return rows.select("_text").mapInArrow(run, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    c = counts.agg(*[F.sum(F.when(F.col("n") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n = [float(x or 0) for x in c]
    if not all(n[:3]):
        return (0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    d = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
    return tuple(min(max(x, 0.1), i + 0.9) for i, x in enumerate(d))


class Model:
    """Count tables by order: grams with their (continuation) counts, contexts
    with their totals, and the discounts."""

    def __init__(self, counts: DataFrame):
        self.grams, self.contexts, self.discounts = {}, {}, {}
        spark, grams = counts.sparkSession, counts
        for k in range(ORDER, 0, -1):
            if k < ORDER:
                # written: else every table that an order is read for derives it from the counts anew
                grams = staged(spark, grams.groupBy(low_order(F.col("g"), k).alias("g")).agg(F.count(F.lit(1)).alias("n")), f"grams{k}")
            one = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
            self.grams[k] = grams
            self.contexts[k] = grams.groupBy(F.shiftright("g", BITS).alias("h")).agg(
                F.sum("n").alias("total"), one(F.col("n") == 1).alias("n1"), one(F.col("n") == 2).alias("n2"), one(F.col("n") > 2).alias("n3")
            )
            self.discounts[k] = _discounts(grams)

    def log_probs(self, asked: DataFrame) -> DataFrame:
        """(g, lp) for the 4-grams ``asked``, by one join a table."""
        p: Column = F.lit(1.0 / ALPHABET)
        rows = asked
        for k in range(1, ORDER + 1):
            gram = low_order(F.col("g"), k)
            rows = rows.withColumn("_g", gram).withColumn("_h", F.shiftright("_g", BITS))
            rows = rows.join(self.grams[k].select(F.col("g").alias("_g"), F.col("n").alias("_n")), "_g", "left")
            rows = rows.join(self.contexts[k].withColumnRenamed("h", "_h"), "_h", "left")
            d1, d2, d3 = self.discounts[k]
            off = F.when(F.col("_n") == 1, d1).when(F.col("_n") == 2, d2).otherwise(d3)
            own = F.greatest(F.coalesce(F.col("_n") - off, F.lit(0.0)), F.lit(0.0))
            spread = d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")
            now = F.when(F.col("total").isNull(), p).otherwise((own + spread * p) / F.col("total"))
            rows = rows.select("g", now.alias("_p"))
            p = F.col("_p")
            rows = rows.withColumnRenamed("_p", f"_p{k}")
            p = F.col(f"_p{k}")
        return rows.select("g", F.log(p).cast("float").alias("lp"))


def cross_entropy(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_hash, lang, n_symbols, nats, peak) per row of documents."""
    ship(docs.sparkSession)
    blocks = block_count(docs, "text", BLOCK_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("lang").cast("string").alias("lang"), F.col("text").alias("_text"), row_block(blocks, "doc_id", "text").alias("_block"))
    placed = rows.repartition(blocks, "_block")

    def asked(part: pa.Table) -> pa.Table:
        drop_held()
        seen, parts, size = np.empty(0, np.int64), [], 0
        for text in part["_text"]:
            parts.append(grams_of(text.as_py()))
            size += len(parts[-1])
            if size >= CHUNK:
                seen, parts, size = distinct(np.concatenate([seen, *parts])), [], 0
        seen = distinct(np.concatenate([seen, *parts]))
        return pa.table({"_block": pa.array(np.full(len(seen), part["_block"][0].as_py(), np.int32)), "g": seen})

    def scored(part: pa.Table, found: pa.Table) -> pa.Table:
        drop_held()
        grams, logs = found["g"].to_numpy(), found["lp"].to_numpy()
        order = np.argsort(grams)  # every gram of the block is among them
        grams, logs = grams[order], -logs[order].astype(np.float64)
        n, nats, peak = [], [], []
        for text in part["_text"]:
            got = logs[np.searchsorted(grams, grams_of(text.as_py()))]
            n.append(len(got))
            nats.append(float(got.sum()))
            peak.append(largest_window(got))
        facts = (("n_symbols", n, pa.int64()), ("nats", nats, pa.float64()), ("peak", peak, pa.float64()))
        out = part.select(["doc_id", "text_hash", "lang"])
        for name, values, kind in facts:
            out = out.append_column(name, pa.array(values, kind))
        return out

    wanted = placed.groupBy("_block").applyInArrow(asked, "_block int, g bigint")
    known = wanted.join(model.log_probs(wanted.select("g").distinct()), "g").repartition(blocks, "_block")
    return placed.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(scored, "doc_id bigint, text_hash bigint, lang string, n_symbols bigint, nats double, peak double")


def largest_window(surprise: np.ndarray) -> float:
    """The largest sum of ``WINDOW`` values in a row (of all, if there are fewer)."""
    if len(surprise) <= WINDOW:
        return float(surprise.sum())
    total = np.concatenate(([0.0], np.cumsum(surprise)))
    return float((total[WINDOW:] - total[:-WINDOW]).max())


def _drawn(mu: Column) -> Column:
    return (F.col("nats") + PRIOR * mu) / (F.col("n_symbols") + PRIOR)


def _level_peak() -> Column:
    """The largest surprise less what a longer text adds to it."""
    return F.col("peak") - F.log(F.col("n_symbols").cast("double"))


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, text_hash, lang, n_symbols, perplexity, bound, peak, peak_bound, kept)
    per row; ``peak`` is without what its length adds."""
    spark = ship(docs.sparkSession)
    ids = staged(spark, trusted_ids(labels), "trusted")
    grams = staged(spark, gram_counts(docs, ids), "grams")
    release(spark)
    model = Model(grams)
    release(spark)
    scored = staged(spark, cross_entropy(docs, model), "entropy")
    release(spark)
    mean = F.col("nats") / F.col("n_symbols")
    held = scored.join(ids.filter("held_out").select("doc_id"), "doc_id", "left_semi")
    every = held.withColumn("lang", F.lit(None).cast("string")).withColumn("all", F.lit(True)).unionByName(held.withColumn("all", F.lit(False)).filter("lang is not null"))
    middle = every.groupBy(F.col("all").alias("_all"), F.col("lang").alias("_lang")).agg(F.percentile_approx(mean, 0.5, 10_000).alias("mu"), F.count(F.lit(1)).alias("docs"))
    with_mu = every.join(middle, F.expr("all <=> _all and lang <=> _lang")).select("all", "lang", "mu", "docs", _drawn(F.col("mu")).alias("drawn"), _level_peak().alias("peak"))
    tops = with_mu.groupBy("all", "lang").agg(F.first("mu").alias("mu"), F.first("docs").alias("docs"), *[F.percentile_approx(c, quantile, 10_000).alias(c) for c in ("drawn", "peak")])
    found = {None if r["all"] else r["lang"]: (r["docs"], r["mu"], r["drawn"], r["peak"]) for r in tops.collect()}  # one row a language
    common = found.pop(None, None)
    own = [F.lit(float(x)) for x in common[1:]] if common else [F.lit(0.0), F.lit(float("inf")), F.lit(float("inf"))]
    for lang, (n, *values) in sorted(found.items()):
        share = n / (n + PRIOR_DOCS)
        own = [F.when(F.col("lang") == lang, share * v + (1 - share) * c).otherwise(o) for o, v, c in zip(own, values, common[1:])]
    mu, top, peak = own
    kept = (_drawn(mu) <= top) & (_level_peak() <= peak)
    return scored.select("doc_id", "text_hash", "lang", "n_symbols", F.exp(mean).alias("perplexity"), F.exp(top).alias("bound"), _level_peak().alias("peak"), peak.alias("peak_bound"), kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``docs`` with all columns, without the documents that are rejected."""
    bad = judged(docs, labels, quantile).filter("not kept").select(F.col("doc_id").alias("_bad"), F.col("text_hash").alias("_badhash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]) & (F.xxhash64(docs["text"]) == bad["_badhash"])
    return docs.join(bad, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "lang", "n_symbols", "perplexity", "bound", "peak", "peak_bound", "kept")
