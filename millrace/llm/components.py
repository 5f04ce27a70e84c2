"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import landed


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links`` (landed): component is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label's own label, so the number of
    rounds grows with the logarithm of the longest chain. Labels and links stay in tables; the driver sees
    one sum per round. Both joins are plain joins of stored tables, which Spark splits where a node has a
    large part of the links.
    """
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
    labels = landed(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    level = None
    while True:
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("s")).first().s
        if total == level:
            return labels
        level = total
        known = labels.select(F.col("node").alias("other"), "component")
        near = both.join(known, "other").select("node", "component").unionByName(labels)
        near = landed(near.groupBy("node").agg(F.min("component").alias("component")), "labels")
        up = near.select(F.col("node").alias("component"), F.col("component").alias("top"))
        labels = landed(near.join(up, "component").select("node", F.col("top").alias("component")), "labels")
