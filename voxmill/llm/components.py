"""Connected components of a graph given as edges, by alternating stars.

Each round joins every node's neighbours to the smallest of them (large star), then every node
and its smaller neighbours to the smallest of those (small star). The number of edges never
grows, and the rounds end when all edges lead to their component's smallest node. A round's
edges are written to the shared folder, so neither lineage nor driver grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def _linked(df: DataFrame) -> DataFrame:
    """Edges as (hi, lo) without loops."""
    return df.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # least has one row per node, so adaptive execution can split a node with very many edges
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    lower = edges.join(least, "hi").select(F.col("lo").alias("a"), F.col("m").alias("b"))
    return lower.unionByName(least.select(F.col("hi").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the component's smallest node) of every node but the roots.

    ``edges`` has the columns a and b, of one orderable type.
    """
    held = scratch.save(_linked(edges).distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    before = state(held)
    while before[0]:
        large = scratch.save(_linked(_large_star(held)), "edges")
        after_both = scratch.save(_linked(_small_star(large)).distinct(), "edges")
        now = state(after_both)
        scratch.drop(large)
        scratch.drop(held)
        held = after_both
        if now == before:
            break
        before = now
    return held.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
