"""Nearest-neighbour price models (inventory N1-N10, J10, K2, F29, F31, F32).

Data rows are ``(id, input array<double>, result double)``.  A query point
is a short literal vector, so distances are one projection over the data and
the k nearest rows come from a distributed top-k (``orderBy().limit(k)``,
planned as TakeOrderedAndProject), with ties broken by id.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import vectors as V

DIST_DIGITS = 9


def wine_price(rating, age) -> Column:
    """F32: peak at rating - 50 years; up to 5x before the peak, falling for
    ten years after it; never below 0."""
    rating, age = F.col(rating) if isinstance(rating, str) else rating, F.col(age) if isinstance(age, str) else age
    peak = rating - 50
    base = rating / 2
    price = F.when(age > peak, base * (5 - (age - peak) / 2)).otherwise(base * (5 * ((age + 1) / peak)))
    return F.greatest(price, F.lit(0.0))


WEIGHTS: dict[str, Callable[[Column], Column]] = {
    "gaussian": lambda d: V.gaussian(d, 5.0),
    "inverse": lambda d: V.inverse_weight(d),
    "subtract": lambda d: V.subtract_weight(d),
}


def _weight(weightf) -> Callable[[Column], Column]:
    """A weight function by name, or any function of a distance column."""
    return weightf if callable(weightf) else WEIGHTS[weightf]


def distances(data: DataFrame, query: list[float], id_col: str = "id", vec: str = "input") -> DataFrame:
    """(id, distance, result) of every row to the query point."""
    d = F.round(V.euclidean(vec, V.lit_vector(query)), DIST_DIGITS)
    return data.select(id_col, d.alias("distance"), "result")


def nearest(data: DataFrame, query: list[float], k: int, id_col: str = "id", vec: str = "input") -> DataFrame:
    """K2: the k nearest rows, ties by id ascending."""
    return distances(data, query, id_col, vec).orderBy("distance", id_col).limit(k)


def knn_estimate(data: DataFrame, query: list[float], k: int = 5, id_col: str = "id", vec: str = "input") -> DataFrame:
    """Mean result of the k nearest rows (fewer rows: mean of those)."""
    return nearest(data, query, k, id_col, vec).agg(F.avg("result").alias("estimate"))


def weighted_knn(data: DataFrame, query: list[float], k: int = 5, weightf: str = "gaussian",
                 id_col: str = "id", vec: str = "input") -> DataFrame:
    """Weight-averaged result of the k nearest rows; 0 when all weights are 0."""
    w = _weight(weightf)(F.col("distance"))
    n = nearest(data, query, k, id_col, vec).select((w * F.col("result")).alias("wr"), w.alias("w"))
    tot = F.sum("w")
    return n.agg(F.when(tot == 0, F.lit(0.0)).otherwise(F.sum("wr") / tot).alias("estimate"))


def prob_guess(data: DataFrame, query: list[float], ranges: DataFrame, k: int = 5, weightf: str = "gaussian",
               id_col: str = "id", vec: str = "input") -> DataFrame:
    """For each (low, high) row of ``ranges``, the weight share of the k
    nearest rows whose result lies in [low, high].

    The k neighbours are few (k rows); they are collected once and the
    ranges table is evaluated against them as literals."""
    nb = nearest(data, query, k, id_col, vec).collect()
    wf = _weight(weightf)
    tw = None
    nw = None
    for r in nb:
        w = wf(F.lit(float(r["distance"])))
        inr = (F.lit(float(r["result"])) >= F.col("low")) & (F.lit(float(r["result"])) <= F.col("high"))
        tw = w if tw is None else tw + w
        term = F.when(inr, w).otherwise(F.lit(0.0))
        nw = term if nw is None else nw + term
    if tw is None:
        return ranges.withColumn("prob", F.lit(0.0))
    return ranges.withColumn("prob", F.when(tw == 0, F.lit(0.0)).otherwise(nw / tw))


def price_grid(spark, high: float, step: float = 0.1) -> DataFrame:
    """0, step, 2*step, ... below ``high`` (the curve's x axis)."""
    n = int(math.ceil(high / step))
    return spark.range(n).select(F.col("id").alias("i"), (F.col("id") * step).alias("v"))


def cumulative_curve(data: DataFrame, query: list[float], high: float, k: int = 5, **kw) -> DataFrame:
    """P(result in [0, v]) for v on the grid."""
    g = price_grid(data.sparkSession, high).select("i", "v", F.lit(0.0).alias("low"), F.col("v").alias("high"))
    return prob_guess(data, query, g, k, **kw).select("i", "v", "prob")


def smoothed_curve(data: DataFrame, query: list[float], high: float, k: int = 5, ss: float = 5.0, **kw) -> DataFrame:
    """P(result in [v, v+0.1]) per bin, smoothed by a gaussian over the
    bin distance |i - j| * 0.1.

    Only bins holding one of the k neighbours have a non-zero probability,
    so the smoothing sum has at most k terms; they are read once and applied
    to every grid row as a literal expression (no bin self-join)."""
    g = price_grid(data.sparkSession, high).select("i", "v", F.col("v").alias("low"), (F.col("v") + 0.1).alias("high"))
    nz = [(r["i"], r["prob"]) for r in prob_guess(data, query, g, k, **kw).where(F.col("prob") > 0).collect()]
    sm = F.lit(0.0)
    for j, pj in nz:
        sm = sm + V.gaussian(F.abs(F.col("i") - F.lit(j)) * 0.1, ss) * F.lit(float(pj))
    return g.select("i", "v", sm.alias("smoothed"))


def random_split(data: DataFrame, id_col: str, test: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Bernoulli split decided by a hash of (id, seed): the same rows
    land in the test set in any partitioning and on any retry."""
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_000)) / 1_000_000.0)
    flagged = data.withColumn("_u", u)
    return flagged.where(F.col("_u") >= test).drop("_u"), flagged.where(F.col("_u") < test).drop("_u")
