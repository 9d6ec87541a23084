"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    Direction, repeats and self-loops of the edges do not matter; edges with a null end are ignored. Each step
    reduces with partial aggregates and is written to the shared folder, so a node of any degree is never gathered
    in one task. The number of steps grows with the logarithm of the number of nodes.
    """
    x, y = F.col(a), F.col(b)
    now = settle(edges.where(x.isNotNull() & y.isNotNull() & (x != y))
                 .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = settle(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
