"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each neighbour above a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point downwards here: link a node and its lower neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of its component.

    Each round is written to the shared folder. Rounds grow with the logarithm of a component's size, and edges never
    become more. Groups are reduced by ``min`` before a shuffle; a node with very many edges meets one row
    per node in a join, whose large side Spark can split.
    """
    current = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    edges_now = current.count()
    while True:
        following = stage(_small_star(_large_star(current)), name)
        edges_then = following.count()
        # Stars stay as they are: every node then has the root as its only neighbour.
        if edges_then == edges_now and following.join(current, ["a", "b"], "left_anti").isEmpty():
            break
        current, edges_now = following, edges_then
    roots = following.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(following.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
