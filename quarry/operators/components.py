"""Connected components of any graph table, by alternating star steps.

A large-star step hangs every neighbour above a vertex on the least vertex of
its neighbourhood; a small-star step does the same below it. Both are one
aggregate and one join, the diameter halves or better, and what is left are
stars around the least vertex of each component. Every round is a written
table: a lost executor costs a round, and plans do not grow. Two numbers a
round reach the driver. Vertices may be of any type that orders and hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (hi, lo): the large star meets all neighbours of a vertex, the
    small star those below it."""
    pairs = edges.select(F.col("hi").alias("at"), F.col("lo").alias("to"))
    if large:
        pairs = pairs.unionByName(edges.select(F.col("lo").alias("at"), F.col("hi").alias("to")))
    least = pairs.groupBy("at").agg(F.min("to").alias("low")).withColumn("low", F.least("low", "at"))
    met = pairs.join(least, "at")
    moved = met.where("to > at" if large else "to <> low").select(F.col("to").alias("hi"), F.col("low").alias("lo"))
    own = least.where("at <> low").select(F.col("at").alias("hi"), F.col("low").alias("lo"))
    return (moved if large else moved.unionByName(own)).where("hi <> lo").distinct()


def components(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """(id, component): every endpoint of an edge, and the least vertex that it
    is connected with. Loops give a component of one; null ends are dropped."""
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    ids = ends.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    links = cut_lineage(ends.where("x <> y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct())
    before = None
    while True:
        row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == before:
            break
        before = (row["n"], row["h"])
        links = cut_lineage(_star(_star(links, True), False))
    return ids.join(links.select(F.col("hi").alias("id"), "lo"), "id", "left").select("id", F.coalesce("lo", "id").alias("component"))
