"""Connected components by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
    low = materialize(low, "large-star")
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = materialize(down.groupBy("u").agg(F.min("v").alias("low")), "small-star")
    ties = down.join(low, "u").select(F.col("v").alias("a"), F.col("low").alias("b"))
    return ties.union(low.select("u", "low"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges(a, b)``; the root is the smallest node reachable.

    Minima combine before they are shuffled, and each join is between a table and its
    minima, so a hub's edges can be split over tasks. Each round is written to the shared
    folder; a lost executor repeats its part of one round. Loops are ignored.
    """
    edges = materialize(edges.toDF("a", "b").where("a <> b").distinct(), "edges")
    mark = None
    while True:
        edges = _small_star(_large_star(edges)).where("a <> b").distinct()
        edges = materialize(edges, "edges")
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            break
        mark = seen
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct()
    )
