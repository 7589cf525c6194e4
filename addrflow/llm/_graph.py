"""Connected components with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.llm._io import stage


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge ends in a node that no edge leaves, and no node has two edges."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the smallest node reachable.

    Large-star and small-star steps in turn, each a minimum per node joined back to the edges; a
    node with very many neighbours is a skewed join key, which Spark may split. Every round is a
    written table. The number of rounds is logarithmic in the longest chain; they end when the edges
    are stars, since the steps keep what is connected.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    while not _are_stars(edges):
        # Large star: all larger neighbours of a node move to its smallest neighbour (or itself).
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")
    )
