"""Clustering (inventory C1, C2, C4, C5, C12, U2).

Vectors are ``(id, vec array<double>)``.  K-means keeps its k centroids as
literal arrays (k x dimensions numbers, independent of the row count):
each round is one pass that assigns every row to its nearest centroid and
one aggregation of the new means.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.session import cut_lineage

DISTANCES = {"pearson": V.pearson_distance, "euclidean": V.euclidean, "tanimoto": V.tanimoto}


def _sum(x: np.ndarray) -> np.ndarray:
    """Sums of rows, added from left to right as the expressions add."""
    return np.cumsum(x, axis=1)[:, -1]


def _euclidean(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(_sum((x - c) ** 2))


def _pearson(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    n, s1, s2 = float(x.shape[1]), _sum(x), _sum(c[None])[0]
    num = _sum(x * c) - s1 * s2 / n
    den = np.sqrt(np.maximum((_sum(x * x) - s1 * s1 / n) * (_sum((c * c)[None])[0] - s2 * s2 / n), 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(den == 0, 0.0, 1.0 - num / den)


# The same distances, of a batch of rows to a centroid.
BATCHED = {"pearson": _pearson, "euclidean": _euclidean}


def _nearest(distance: Callable, cents: list) -> Callable:
    """A vectorised function from vectors to the index of the nearest centroid,
    ties to the lower. A vector that is null, lacks a value or has another
    length is at no distance from any, which is a tie."""
    centroids = np.array(cents, np.float64)

    @F.pandas_udf("int")
    def nearest(vecs: pd.Series) -> pd.Series:
        dims = centroids.shape[1]
        out = np.zeros(len(vecs), np.int32)
        whole = np.array([v is not None and len(v) == dims for v in vecs], bool)
        if whole.any() and dims:
            x = np.stack([np.asarray(v, np.float64) for v in vecs[whole]])
            d = np.stack([distance(x, c) for c in centroids], axis=1)
            out[whole] = np.argmin(np.where(np.isnan(d), np.inf, d), axis=1)
        return pd.Series(out)

    return nearest


def rotate(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """C4: transpose, in long form (pos -> row, id -> column):
    (row, col, x).  Each output row of the dense transpose would hold one
    value per input row, so the long form is the scalable shape."""
    return df.select(F.posexplode(vec).alias("row", "x"), F.col(id_col).alias("col"))


def _cluster(vec: str, distance, dist: Callable, cents: list) -> Column:
    batched = None if callable(distance) else BATCHED.get(distance)
    # a range that no value gives (a column of nulls) leaves a centroid without place
    if batched and all(x is not None for c in cents for x in c):
        return _nearest(batched, cents)(vec)
    ds = F.array(*[F.struct(dist(vec, V.lit_vector(c)).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(cents)])
    return F.array_min(ds)["i"]


def kmeans(df: DataFrame, id_col: str, vec: str, k: int = 4, distance="pearson", max_iter: int = 100,
           seed: int = 0) -> tuple[DataFrame, list]:
    """Lloyd iterations with a chosen distance (a name of ``DISTANCES`` or
    a function of two vector columns).

    Start: k random points inside the per-dimension [min, max] ranges
    (seeded).  Each round assigns every row to the nearest centroid (ties to
    the lower index), recomputes means, keeps the old centroid of an empty
    cluster, and stops when the assignment no longer changes (compared by a
    checksum of the assignment) or after max_iter rounds. Means and checksum
    come from the same pass; the distances of ``BATCHED`` are taken in batches.
    Returns (assignment (id, cluster), centroids)."""
    dist = distance if callable(distance) else DISTANCES[distance]
    df = cut_lineage(df.select(id_col, vec))      # read every round
    dims = df.agg(F.max(F.size(vec))).first()[0] or 0
    ends = df.agg(*[f(F.get(F.col(vec), F.lit(i))).alias(f"{n}{i}") for i in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    rnd = random.Random(seed)
    cents = [[ends[f"lo{i}"] + rnd.random() * (ends[f"hi{i}"] - ends[f"lo{i}"]) for i in range(dims)] for _ in range(k)]
    last = None
    assign = None
    for _ in range(max_iter):
        assign = df.select(id_col, vec, _cluster(vec, distance, dist, cents).alias("cluster"))
        h = F.xxhash64(id_col, "cluster")
        # k rows of dims numbers; one aggregate per dimension, nothing exploded
        means = assign.groupBy("cluster").agg(
            F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(2_147_483_647))).alias("s"),
            *[F.avg(F.get(F.col(vec), F.lit(i))).alias(f"m{i}") for i in range(dims)]).collect()
        sig = sorted((r["cluster"], r["x"], r["s"]) for r in means)
        if sig == last:
            break
        last = sig
        for r in means:
            cents[r["cluster"]] = [r[f"m{i}"] for i in range(dims)]
    return assign.select(id_col, "cluster"), cents


def weighted_kmeans(df: DataFrame, features: list[str], weight: str, k: int = 3, seed: int = 0):
    """K-means of points that stand for ``weight`` equal rows each, by
    Spark's own estimator.  Returns (rows with ``cluster``, centroids)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=features, outputCol="_v").transform(df)
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster", weightCol=weight).fit(data)
    return model.transform(data).drop("_v"), [list(map(float, c)) for c in model.clusterCenters()]
