"""Connected components of a link table, as DataFrame jobs.

Every node takes the smallest label among itself and its neighbours, then the
label of its label (pointer jumping), until nothing changes. Links and labels
stay distributed; each round is written to the shared folder, so a lost
executor costs at most one round. A node with very many links is reduced per
task before the shuffle. Links that come later join components, not nodes: only
the components they touch are gone through again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import staged, staged_count


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); ``label`` is the smallest
    node reachable. Nodes without links are not listed."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = staged(spark, first.select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b")
        low = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(low, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = step.select(F.col("node").alias("mid"), F.col("mid").alias("top"))
        moved = step.join(jump, "mid").select("node", "old", F.least("mid", "top").alias("label"))
        kept, changed = staged_count(spark, moved, "labels", F.expr("old != label"))
        labels = kept.select("node", "label")
        if not changed:
            return labels


def extended(spark: SparkSession, labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``components`` of the links that ``labels`` come from (none yet: ``None``)
    and of ``links`` together."""
    if labels is None:
        return components(spark, links)
    a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}")) for c in ("a", "b"))
    ends = links.join(a, "a", "left").join(b, "b", "left").select("a", "b", F.coalesce("_a", "a").alias("x"), F.coalesce("_b", "b").alias("y"))
    ends = staged(spark, ends, "ends")
    merged = components(spark, ends.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    known = labels.union(ends.select("a", "x")).union(ends.select("b", "y")).distinct()
    now = known.join(merged.select(F.col("node").alias("label"), F.col("label").alias("least")), "label", "left")
    return staged(spark, now.select("node", F.coalesce("least", "label").alias("label")), "labels")
