"""Connected components of a graph given as rows, by alternating star contraction.

Each round rewires edges so that a node points to the smallest node it has met; both steps keep
the components and the number of rows about constant, and rounds grow with the logarithm of the
diameter. Nothing is collected; every round is a written table, so lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a").filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return others.unionByName(own).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every non-root node.

    ``edges`` has the long columns ``a`` and ``b``. Self-loops, nulls and repeats are ignored.
    """
    edges, mark = edges.select("a", "b").filter("a <> b"), None
    while True:
        edges = stage(_small_star(_large_star(edges)), "edges")
        # Equal rows give an equal sum; the sum of all roots strictly falls until the end.
        summed = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(summed) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(summed)
