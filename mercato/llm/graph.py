"""Connected components of a graph that never leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node of
    its component.

    Alternates two steps until nothing changes: every node hands its smallest
    known neighbour to the larger neighbours (large star), then to the smaller
    ones (small star). Each step is one grouped minimum (combined before the
    shuffle) and one join that Spark may split where a node has very many
    neighbours. Rounds grow with the logarithm of the longest path; each is
    cut off by a reliable checkpoint.
    """
    links = (edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint())
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .union(least.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        links = small.checkpoint()
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
