"""Connected components of an undirected graph of rows, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.session import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable.

    Rounds of contraction: every node points at its smallest neighbour if that is smaller, pointers
    are followed to their roots by doubling, and edges move to the roots, until none is left. Every
    root that still has an edge merges with another each round, so there are logarithmically many.
    Each step is a table in the shared folder. Self-loops and repeated edges are harmless.
    """
    found: DataFrame | None = None
    left = cut(edges.select("a", "b").where("a <> b").distinct())
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        up = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                 .select("node", F.least("node", "low").alias("root")))
        while True:
            over = up.select(F.col("node").alias("root"), F.col("root").alias("next")).where("next <> root")
            jumped = cut(up.join(over, "root", "left").select("node", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")))
            up = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        found = up if found is None else cut(
            found.join(up.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("node", F.coalesce("next", "root").alias("root")))
        ends = lambda df, c: df.join(up.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c)
        left = cut(ends(ends(left, "a"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                   .where("a <> b").distinct())
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return found.select("node", F.col("root").alias("component"))
