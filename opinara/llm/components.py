"""Connected components of a large graph by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.storage import stage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``edges`` (a, b).

    A round takes the smallest label among a node and its neighbours, then the label of that label; the distance to the
    smallest node shrinks by a constant factor. Each round is written out. Only one count per round reaches the driver.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = stage(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = stage(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        told = labels.select(F.col("node").alias("other"), F.col("component").alias("told"))
        heard = both.join(told, "other").groupBy("node").agg(F.min("told").alias("told"))
        nearer = labels.join(heard, "node").select("node", F.least("component", "told").alias("component"), F.col("component").alias("before"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        jumped = nearer.join(jump, "component", "left").select(
            "node", F.coalesce(F.least("component", "beyond"), F.col("component")).alias("component"), "before"
        )
        after = stage(jumped, "labels")
        labels = after.select("node", "component")
        if after.filter("component != before").isEmpty():
            return labels
