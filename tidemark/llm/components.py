"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Scratch


def _least_neighbour(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, m): the smallest of a node and its neighbours; and the links in both directions."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select("b", "a"))
    return both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), both


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b: long, b > a); the component is its smallest node.

    Each round hangs every larger neighbour on a node's smallest neighbour, then the smaller ones, until
    nothing changes; the number of rounds grows with the logarithm of the longest chain. Minima are
    pre-aggregated, so a node with very many links is no hot task.
    """
    now = scratch.write(links.select("a", "b").distinct(), "links")
    mark = None
    while True:
        least, both = _least_neighbour(now)
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
        downs = large.groupBy("b").agg(F.min("a").alias("m"))
        hung = large.join(downs, "b")
        small = hung.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionAll(downs.select(F.col("m").alias("a"), "b"))
        after = scratch.write(small.where("a < b").distinct(), "links")
        scratch.drop(now)
        now = after
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == mark:
            break
        mark = state
    hung = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return hung.unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
