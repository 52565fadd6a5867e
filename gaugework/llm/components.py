"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import stored


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    lowest = _lowest(edges)
    moved = edges.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has a link to another; the component is its smallest node.

    Each round is written to the shared folder, so no plan grows and no executor holds the only copy. The number of
    rounds grows with the logarithm of the longest chain. Links of a node to itself, repeated and null ones add nothing;
    without links the result is empty. Smallest neighbours are counted before the shuffle, and the joins are on one row
    a node, so adaptive execution can split a node with very many links.
    """
    edges = stored(
        links.filter(f"{a} != {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "links")
