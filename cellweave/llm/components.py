"""Connected components of a graph by smallest label, with joins and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node in edges(a, b).

    A round takes the smallest label among neighbours and then the label of that label, so paths
    shrink by half; each round is written to the shared folder. Rows never exceed twice the edges.
    """
    both = written(edges.select("a", "b").where("a <> b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct(), "edges")
    now = written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        said = both.join(now.select(F.col("node").alias("b"), F.col("component").alias("near")), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        low = written(now.join(said, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")), "low")
        ahead = low.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = written(low.join(ahead, "component").select("node", "old", F.col("next").alias("component")), "labels")
        if not after.where("old <> component").take(1):
            return after.select("node", "component")
        now = after.select("node", "component")
