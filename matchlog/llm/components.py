"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is
    its smallest node.  Every round takes the smallest label among neighbours
    (combined before the shuffle, so hubs are cheap) and then the label's own
    label, which halves long chains; rounds are stored, so a lost executor
    costs one round.  Stops when a round changes nothing."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("component").alias("near"))
            .select(F.col("a").alias("node"), "near")
        )
        lower = labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        lower = stored(lower, "labels")
        up = lower.select(F.col("node").alias("component"), F.col("component").alias("top"))
        labels = lower.join(up, "component").select("node", F.least("component", "top").alias("component"), "before")
        labels = stored(labels, "labels")
        if labels.where("component <> before").isEmpty():
            return labels.select("node", "component")
