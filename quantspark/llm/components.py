"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b).

    Each round takes the smallest label among a node's neighbours and then the label of that label, so that paths halve;
    rounds end when no label changes. Tables of a round are written to the shared folder.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a")).filter("node <> near").distinct()
    both = staged(both, "edges")
    labels = staged(both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), F.col("component").alias("of_near")), "near").groupBy("node").agg(F.min("of_near").alias("of_near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "of_near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("of_label"))
        now = staged(lower.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("of_label", "label")).alias("component")), "labels")
        changed = not now.filter("was <> component").limit(1).isEmpty()
        labels = now.select("node", "component")
        if not changed:
            return labels
