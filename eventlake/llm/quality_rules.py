"""Quality rules as a bitmask ledger (Spark expressions only).

``ledger`` evaluates every rule once per document and stores the
measurements and one failure bit per rule. A policy is a versioned set of
rules, i.e. a mask: ``apply_policy`` and ``ablation`` work on the stored bits
and never touch a text again.

Defined results: a null or empty text has no words, fails ``few_words`` and
nothing else; null doc_ids are kept as null; repeated rows are judged row by
row; extra columns are ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import SPACE_CLASS, table

MIN_WORDS = 50
REPEAT_PERCENT = 50

#: Rules in bit order: name and the condition (over the measurements) that fails.
RULES: list[tuple[str, str]] = [
    ("few_words", f"n_words < {MIN_WORDS}"),
    ("repeated_windows", f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("capitals", "2 * n_capitals > word_chars"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}

#: Policies by version: the rules that reject a document.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    "v2": [name for name, _ in RULES],
}

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"]


def mask_of(policy: str) -> int:
    return sum(1 << BIT[name] for name in POLICIES[policy])


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, measurements): one pass over each whole text, arrays inside the row."""
    words = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t")).select(
        key,
        "_t",
        F.expr(f"filter(split(_t, '{SPACE_CLASS}+'), w -> w != '')".replace("\\", "\\\\")).alias("_w"),
        F.expr("filter(split(_t, '\\n'), l -> l rlike '[^ \\\\x09-\\\\x0D]')").alias("_l"),
    )
    # every 3-word window; words hold no blank, so the joined text is unambiguous
    windows = words.withColumn(
        "_g",
        F.expr(
            "if(size(_w) < 3, cast(array() as array<string>), "
            "transform(sequence(0, size(_w) - 3), i -> concat_ws(' ', _w[i], _w[i + 1], _w[i + 2])))"
        ),
    )
    # windows in sorted order stand beside their equals; documents without a
    # repeated window (the usual case) are not sorted
    ordered = windows.withColumn(
        "_s",
        F.expr(
            "if(size(array_distinct(_g)) = size(_g), cast(array() as array<struct<g: string, i: int>>), "
            "sort_array(transform(_g, (g, i) -> struct(g, i))))"
        ),
    )
    repeated = ordered.withColumn(
        "_p",
        F.expr(
            "sort_array(transform(filter(_s, (x, i) -> (i > 0 and _s[i - 1].g = x.g) or "
            "(i < size(_s) - 1 and _s[i + 1].g = x.g)), x -> x.i))"
        ),
    )
    return repeated.select(
        key,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        # a start covers three words, less where the next start is nearer
        F.expr(
            "aggregate(transform(_p, (p, k) -> if(k < size(_p) - 1, least(3, _p[k + 1] - p), 3)), 0L, (a, x) -> a + x)"
        ).alias("n_repeat_words"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"\p{Lu}", ""))).cast("long").alias("n_capitals"),
    )


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, measurements, fail_bits): bit i is set where rule i fails."""
    bits: Column = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits + F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return measured(docs, key, text).withColumn("fail_bits", bits)


def apply_policy(kept_ledger: DataFrame, policy: str, into: str = "kept") -> DataFrame:
    return kept_ledger.withColumn(into, F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0)


def ablation(kept_ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone (what the
    policy would keep without it), and the bits that fail together with it.

    The ledger shrinks to one row per failure pattern before rules are laid
    beside it, so nothing of corpus size is shuffled.
    """
    mask = mask_of(policy)
    patterns = kept_ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("docs")
    )
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << BIT[n]).cast("long").alias("bit")) for n in POLICIES[policy]])
    rows = patterns.select("bits", "docs", F.explode(rules).alias("r")).select("bits", "docs", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("docs")).otherwise(0)).alias("n_failed_alone"),
        F.coalesce(F.bit_or(F.when(hit, F.col("bits"))), F.lit(0)).alias("failed_with_bits"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(apply_policy(ledger(table(spark, sf_dir, "documents")), "base", "_base"), "v2")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~F.col("_base")).alias("base_failed"),
        (F.col("_base") & F.col("kept")).alias("kept"),
        "fail_bits",
    )


#: Written out on its own: windows and lines as rows, counted by grouping.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS caps
  FROM d LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
b AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
       + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (100 * n_dup_lines > 30 * n_lines)::INT
       + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
       + 64 * (2 * caps > word_chars)::INT AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""
