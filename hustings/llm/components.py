"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of edges (two long columns): root is the smallest node that it is connected to.

    Each round points every neighbour at the smallest node of its neighbourhood, so paths shrink by about half; the
    number of rounds grows with the logarithm of the longest path. Rounds end when the table no longer changes, which
    two counts tell, and each is written to the shared folder. Loops and repeated edges do no harm; an empty table
    gives an empty result.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct())
    before = None
    while before != (state := tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())):
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join has a plain exchange on both sides and Spark can split the edges of a node with many.
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        now = written(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
