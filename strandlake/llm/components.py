"""Connected components of a graph given as edges, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.settle import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b); root is the least node of its component.

    Each round takes the least label among a node's neighbours and then that label's own label, so that the
    number of rounds is about the logarithm of the longest path. Labels are written between rounds; only the number of
    changed labels reaches the driver.
    """
    both = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("m"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        ahead = labels.select(F.col("node").alias("at"), F.col("root").alias("next"))
        after = settle(lower.join(ahead, lower["root"] == ahead["at"], "left").select("node", "old", F.coalesce(F.least("root", "next"), "root").alias("root")), "labels")
        labels = after.select("node", "root")
        if after.where("old != root").isEmpty():
            return labels
