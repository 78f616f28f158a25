"""Connected components by alternating large and small stars.

Edges are joined by node with a row for each node, so the edges of a node of a very large component come to one
task, unless Spark's skew join splits them, which it does by their bytes; none is held there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordspark.llm.common import cut

#: Edges in a file that a round writes, about.
FILE = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node of `edges` (a, b) but the roots.

    The number of rounds grows with the logarithm of the number of nodes; each is cut off from the last.
    """
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    edges = cut(edges.where("a <> b").select("a", "b").distinct())
    before = edges.select(mark.alias("m")).first()["m"]
    while True:
        # a round has about as many edges as the one before, and is written in as few files as they need
        edges = cut(_small_star(_large_star(edges)).where("a <> b").distinct().coalesce(1 + before[0] // FILE))
        now = edges.select(mark.alias("m")).first()["m"]
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
