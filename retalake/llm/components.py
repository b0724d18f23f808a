"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalake.session import Scratch


def _neighbours(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.union(back)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = _neighbours(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Edges run from the larger node ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a > b")


def connected_components(edges: DataFrame, tables: Scratch, name: str) -> DataFrame:
    """(node, component): for every node with a link the smallest node that it reaches.

    ``edges`` has two comparable columns ``a`` and ``b``; loops, repeats and
    nulls do no harm. Both steps move one row per link and sum per node before
    the shuffle; each round is written, so a lost executor costs one round.
    Rounds grow with the logarithm of the number of nodes.
    """
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = tables.save(links, f"{name}-0")
    before, step = None, 0
    while True:
        step += 1
        links = tables.save(_small_star(_large_star(links).distinct()).distinct(), f"{name}-{step}")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
