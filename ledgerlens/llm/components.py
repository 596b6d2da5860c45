"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in edges (a, b): label is the smallest node reachable.

    Each round takes the smallest label among neighbours, then the label's own
    label, so long chains shrink by powers of two. Every round is written to
    the shared folder; only the number of changes reaches the driver. A node
    with very many neighbours is pre-aggregated before each shuffle.

    Edge cases: edges with a null end and loops are dropped, repeated edges
    count once, and an empty table has no nodes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = stored(both, "cc-edges")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "cc-0")
    if labels.isEmpty():
        return labels
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("old"))
        own = labels.select("node", "label", F.col("label").alias("old"))
        low = near.unionByName(own).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        nxt = low.join(up, "label").select("node", "old", F.least("label", "up").alias("label"))
        nxt = stored(nxt, "cc-round")
        changed = nxt.where("old <> label").count()
        labels = nxt.select("node", "label")
        if not changed:
            return labels
