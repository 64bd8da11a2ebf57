"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step hangs neighbours on the smallest of them, found by a minimum that combines before the shuffle; no
neighbour list is ever gathered. Steps are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import cut


def _smallest(pairs: DataFrame) -> DataFrame:
    """For edges (u, v): the smallest of u and its v."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = _smallest(down)
    hung = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def roots(edges: DataFrame) -> DataFrame:
    """For edges (u, v) of whole numbers: (node, root) for every node that is not the smallest of its component."""
    current = cut(edges.select("u", "v").where("u <> v").distinct())
    before = None
    while (now := _state(current)) != before:
        before = now
        if not now[0]:
            break
        current = cut(_small_star(_large_star(current)))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
