"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node reachable, for every node that has an edge.

    Each round takes the smallest label among neighbours and then the label's own label, so paths
    shorten by more than half and stars end in two rounds. Every round is written, so a lost
    executor costs no earlier round. Only the number of changed labels reaches the driver.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = both.union(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).where("u <> v").distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("other")), "v")
        least = near.groupBy("u").agg(F.min("other").alias("other"))
        stepped = labels.join(least, "u").select("u", "label", F.least("label", "other").alias("new"))
        jump = labels.select(F.col("u").alias("at"), F.col("label").alias("far"))
        jumped = stepped.join(jump, stepped["new"] == jump["at"]).select(
            "u", "label", F.least("new", "far").alias("new")
        )
        jumped = cut_lineage(jumped)
        changed = jumped.where("new <> label").limit(1).count()
        labels = jumped.select("u", F.col("new").alias("label"))
        if not changed:
            return labels.select(F.col("u").alias("node"), F.col("label").alias("root"))
