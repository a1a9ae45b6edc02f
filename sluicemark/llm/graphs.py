"""Connected components and page rank over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicemark.session import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge, the component being its smallest node.

    Large and small stars in turn: every node is linked to the smallest of its neighbourhood, first
    its larger neighbours, then its smaller ones.  The number of rounds grows with the logarithm of
    the component's size, not with its diameter.  Each round is written to the shared folder, and a
    node with many links is summed before the shuffle and split in the join.  Null ends are left out.
    """
    links = edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).filter(F.col("high") > F.col("low"))
    links = staged(links.distinct())
    while True:
        both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
        smallest = both.groupBy("high").agg(F.min(F.least("high", "low")).alias("least"))
        large = (
            both.filter(F.col("low") > F.col("high")).join(smallest, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        )
        large = staged(large.distinct())
        least = large.groupBy("high").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("n"))
        small = large.join(least, "high").filter(F.col("low") > F.col("least")).select(F.col("low").alias("high"), F.col("least").alias("low"))
        chained = large.join(least.select(F.col("high").alias("low")), "low", "left_semi")
        if small.isEmpty() and chained.isEmpty():
            return large.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
                large.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            )
        links = staged(small.union(least.select("high", F.col("least").alias("low"))).distinct())
