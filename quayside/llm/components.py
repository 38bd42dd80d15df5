"""Connected components of a list of links, by rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import materialise, small


def _neighbours(links: DataFrame) -> DataFrame:
    """For each node, the least of it and its neighbours, and the largest neighbour; written."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return materialise(both.groupBy("a").agg(
        F.least(F.min("b"), F.first("a")).alias("least"), F.max("b").alias("most")), "least")


def _towards_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """Point every neighbour of a node that is larger than the node at the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a node with very many links meets one row; adaptive execution splits it
    return both.where("b > a").join(small(least.select("a", "least")), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _shorten(links: DataFrame) -> DataFrame:
    """With every link from the larger to the smaller node: point a node and its smaller neighbours at the least of them."""
    least = materialise(links.groupBy("a").agg(F.min("b").alias("least")), "least")
    moved = links.join(small(least), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node that each linked node is connected with, the least node itself included; written.

    `links` has the columns a and b; it is read several times, so it should be
    a written table. Large-star and small-star steps alternate until all links
    go from a node to its root, about as often as the logarithm of the longest
    chain squared; a node is never gathered with all its links. Links of a node
    with itself and repeated links are harmless; without links there are no rows.
    """
    links = links.select("a", "b").where("a <> b")
    while True:
        least = _neighbours(links)
        # stars: who has a smaller neighbour has no other one
        if least.where("least < a AND least < most").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("least").alias("root"))
        links = materialise(_shorten(_towards_least(links, least)), "links")
