"""Connected components by alternating large-star and small-star steps.

Every step is one aggregation and one join on edges; each round's edges are
written to the shared checkpoint folder, so a lost executor costs one round at
most and the plan does not grow. Nothing is collected but two sums per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, with that
    smallest node. ``edges``: long columns u and v in any order; loops and
    repeated edges do no harm."""
    edges = (edges.where("u <> v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges = cut_lineage(edges)
    state = _state(edges)
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        new = _state(edges)
        if new == state:
            return edges
        state = new
