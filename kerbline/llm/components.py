"""Connected components of a graph of any size, by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import broadcast_if_small, settle


def _state(edges: DataFrame) -> tuple:
    """What tells one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reached) of every node that a link a, b touches.

    Stars are drawn in turn until all is still: each node hands its larger neighbours, then itself and its smaller
    ones, to the smallest neighbour. Every round is written, so lost executors cost one round. Hubs are no trouble: their
    minimum is taken next to the scan and joined back from a written table, where Spark can split a large key.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "star-edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        low = broadcast_if_small(settle(low, "star-low"), 32)
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = settle(large.filter("u > v").distinct(), "star-edges")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        low = broadcast_if_small(settle(low, "star-low"), 32)
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v"))
        )
        edges = settle(small.filter("u > v").distinct(), "star-edges")
        before, state = state, _state(edges)
        if state == before:
            break
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return settle(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops), "star-labels")
