"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import forget, stash


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, of every node on an edge.

    edges: a, b of one sortable type. Loops and repeated edges do no harm. Large-star and small-star steps alternate
    until no edge changes, about log(n) times; each step groups edges by node with a partial minimum and joins that
    minimum back, so no neighbourhood is gathered. Every round is a written table.
    """
    edges = stash(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.filter("a <> m").select("a", F.col("m").alias("b"))).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        before, edges = edges, stash(small.distinct(), "edges")
        forget(before)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = now
