"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_narrow


def smallest_labels(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``); the label is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then the label of that label,
    so a chain of n nodes needs about log n rounds. Rounds are written to the shared folder.
    """
    both = cut_narrow(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = cut_narrow(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = step.select(F.col("node").alias("t"), F.col("label").alias("further"))
        jump = step.join(target, F.col("label") == F.col("t"), "left")
        jump = cut_narrow(jump.select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"))
        changed = jump.filter("label <> old").limit(1).count()
        labels = jump.select("node", "label")
        if not changed:
            return labels
