"""Connected components of an edge table by min-label propagation with
pointer jumping; every round is a written table, and the loop ends only when
a round changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, label): label is the smallest node
    of the component.  Nodes are those with an edge; no edges, no rows."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        best = (labels.join(near, "node")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = labels.select(F.col("node").alias("p"), F.col("label").alias("plabel"))
        step = written(best.join(up, best.label == up.p, "left")
                       .select("node", "old", F.least("label", F.coalesce("plabel", "label")).alias("label")), "cc-labels")
        changed = step.where("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
