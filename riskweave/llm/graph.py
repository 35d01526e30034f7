"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``links``.

    Every round each node takes the smallest label among its neighbours, and then the label of
    its label, so that the rounds grow with the logarithm of a path's length. Labels are
    aggregated before they are shuffled; nothing is collected but one count per round.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where(F.col("node") != F.col("other"))
    both = materialize(both.union(both.select("other", "node")).distinct(), "links")
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component"))
    labels = materialize(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other")
        near = near.groupBy("node").agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = step.join(jump, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("further", "component")).alias("component"))
        moved = materialize(moved, "labels")
        changed = moved.where(F.col("old") != F.col("component")).limit(1).count()
        labels = moved.select("node", "component")
        if not changed:
            return labels
