"""Corpus pipeline: five stages over ``documents``, each an operator of ``eventlake.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps, with the columns of ``docs`` (the last one adds the
token columns). ``run`` applies them in order; each result is written to the
shared checkpoint folder and read again, which cuts the lineage.

Null and empty texts, repeated rows, empty tables and further columns have the
results that the operators define; a document without words is no duplicate
of any other and stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import bpe, decontamination, kneser_ney, near_dedup, suffix_dedup
from eventlake.llm.common import ship, staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity the classifier accepts."""
    return kneser_ney.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8."""
    return near_dedup.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what earlier documents have said already."""
    left = suffix_dedup.remove_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with fewer than one word in twenty from a benchmark window."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, encoded and decoded again."""
    return bpe.encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", benchmarks),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(spark, docs, f"stage{i}")
    return docs


#: No SQL for the language model, the automaton and the merges; the stages are
#: tested against brute-force versions.
ORACLE_SQL = None
