"""Exact k nearest rows of every query (inventory J10, K2, N1-N3, N5, N6).

Rows are dealt to their nearest pivot. A query needs the rows of a pivot only
if its distance to the pivot, less the pivot's radius, is within a bound that k
rows are known to meet (the triangle inequality); the bound comes from the
pivots' radii and counts alone. A pivot's rows are split into blocks and its
queries into chunks, so a task holds one block and one chunk whatever the
pivot's share of the rows, keeps k rows per query, and these are merged by a
limited window. Nothing is sampled or capped: with bad pivots a query meets
more blocks, not fewer neighbours.

Only the pivots (``PIVOTS`` vectors) and a count and radius of each pass the
driver. Rows and queries without a vector take no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.knn import DIST_DIGITS
from quarry.session import cut_lineage

PIVOTS = 64
#: Rows of a block and queries of a chunk.
BLOCK, CHUNK = 4096, 512
#: Slack of the triangle inequality against rounding.
SLACK = 1e-6


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column as rows of a matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def choose_pivots(data: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """``n`` rows' vectors, picked by a hash of the id."""
    rows = data.select("id", "input").orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(n).collect()
    return np.array([r["input"] for r in rows], np.float64)


def _dealt(data: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``data`` with ``part``, the nearest pivot, and ``off``, its distance."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = _to_pivots(_matrix(b.column(1)), pivots)
                part = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part.astype(np.int32)), pa.array(d[np.arange(len(d)), part])],
                                                 ["id", "input", "result", "held", "part", "off"])

    return data.mapInArrow(deal, "id long, input array<double>, result double, held long, part int, off double")


def _routed(queries: DataFrame, pivots: np.ndarray, radius: np.ndarray, counts: np.ndarray, k: int) -> DataFrame:
    """A row per query and pivot whose rows it must meet. ``counts``: rows of
    each pivot for every trial, the last column without any row held out."""

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = _to_pivots(_matrix(b.column(2)), pivots)
            order = np.argsort(d + radius, axis=1)
            far = np.take_along_axis(d + radius, order, axis=1)
            trial = b.column(1).to_numpy()
            have = np.cumsum(counts[order, trial[:, None]], axis=1)
            enough = have >= k + 1  # the row itself may be among them
            bound = np.where(enough.any(axis=1), far[np.arange(len(far)), enough.argmax(axis=1)], np.inf)
            row, part = np.nonzero(d - radius <= bound[:, None] + SLACK)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array(part.astype(np.int32))],
                                             ["query_id", "trial", "vec", "part"])

    return queries.mapInArrow(route, "query_id long, trial int, vec array<double>, part int")


def _spread(df: DataFrame, sizes: DataFrame, own: str, other: str, key: Column) -> DataFrame:
    """``df`` with its own number among the pieces of its side of a part, once
    for each piece of the other side."""
    return (df.join(F.broadcast(sizes), "part").withColumn(own, F.pmod(key, F.col(f"n_{own}")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))).drop("n_block", "n_chunk"))


def nearest_join(data: DataFrame, queries: DataFrame, k: int, n_pivots: int = PIVOTS, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, trial, id, distance, result, rank): the k nearest rows of
    every query, ties by id, the row of the query's own id left out.

    ``data``: (id, input, result) and, if rows are held out in some trials,
    ``held``, a bit set per trial. ``queries``: (query_id, input) and, for
    trials, ``trial``, whose held-out rows are no neighbours."""
    held = F.col("held") if "held" in data.columns else F.lit(0)
    data = data.where(F.col("input").isNotNull()).select(
        F.col("id").cast("long").alias("id"), F.col("input").cast("array<double>").alias("input"),
        F.col("result").cast("double").alias("result"), held.cast("long").alias("held"))
    trial = F.col("trial") if "trial" in queries.columns else F.lit(-1)
    queries = queries.where(F.col("input").isNotNull()).select(
        F.col("query_id").cast("long").alias("query_id"), trial.cast("int").alias("trial"), F.col("input").cast("array<double>").alias("vec"))
    schema = "query_id long, trial int, id long, distance double, result double"
    spark = data.sparkSession
    pivots = choose_pivots(data, n_pivots)
    if not len(pivots):
        return spark.createDataFrame([], schema + ", rank int")
    rows = cut_lineage(_dealt(data, pivots))
    bits = queries.agg(F.max("trial")).first()[0]
    trials = 0 if bits is None else bits + 1
    free = [F.count_if(F.col("held").bitwiseAND(F.lit(1 << t)) == 0).alias(f"t{t}") for t in range(trials)]
    parts = rows.groupBy("part").agg(F.max("off").alias("off"), *free, F.count(F.lit(1)).alias("all")).collect()  # a row per pivot
    radius, counts = np.full(len(pivots), -np.inf), np.zeros((len(pivots), trials + 1), np.int64)
    for r in parts:
        radius[r["part"]] = r["off"]
        counts[r["part"]] = [r[f"t{t}"] for t in range(trials)] + [r["all"]]
    asked = cut_lineage(_routed(queries, pivots, radius, counts, k))
    ceil = lambda n: F.greatest(F.ceil(n).cast("int"), F.lit(1))
    sizes = (rows.groupBy("part").agg(ceil(F.count(F.lit(1)) / block).alias("n_block"))
             .join(asked.groupBy("part").agg(ceil(F.count(F.lit(1)) / chunk).alias("n_chunk")), "part"))  # a row per pivot
    left = _spread(rows.drop("off"), sizes, "block", "chunk", F.xxhash64("id"))
    right = _spread(asked, sizes, "chunk", "block", F.xxhash64("query_id", "trial"))

    def meet(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(theirs):
            x, ids, results = np.stack(mine["input"].to_numpy()), mine["id"].to_numpy(), mine["result"].to_numpy(np.float64)
            held_out = mine["held"].to_numpy()
            for q, t, v in zip(theirs["query_id"], theirs["trial"], theirs["vec"], strict=True):
                d = np.round(np.sqrt(((x - v) ** 2).sum(axis=1)), DIST_DIGITS)
                able = ids != q
                if t >= 0:
                    able &= (held_out >> t) & 1 == 0
                at = np.flatnonzero(able)
                if len(at) > k:  # ties with the k-th stay until the ids decide
                    at = at[d[at] <= np.partition(d[at], k - 1)[k - 1]]
                at = at[np.lexsort((ids[at], d[at]))][:k]
                out.append(pd.DataFrame({"query_id": q, "trial": t, "id": ids[at], "distance": d[at], "result": results[at]}))
        if not out:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (
                ("query_id", "int64"), ("trial", "int32"), ("id", "int64"), ("distance", "float64"), ("result", "float64"))})
        return pd.concat(out, ignore_index=True)

    cell = ["part", "block", "chunk"]
    near = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(meet, schema)
    order = Window.partitionBy("query_id", "trial").orderBy("distance", "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def estimates(near: DataFrame, weight: Column | None = None) -> DataFrame:
    """(query_id, trial, estimate) from rows of ``nearest_join``: the
    mean of the results, or their mean by ``weight``, a column made of
    ``distance``; 0 if all weights are 0."""
    w = F.lit(1.0) if weight is None else weight
    total = F.sum(w)
    return near.groupBy("query_id", "trial").agg(
        F.when(total == 0, F.lit(0.0)).otherwise(F.sum(w * F.col("result")) / total).alias("estimate"))


def held_out(id_col: Column, trials: int, percent: int) -> Column:
    """A bit per trial (at most 62), set for about ``percent`` of the ids."""
    h = lambda t: F.conv(F.substring(F.md5(F.concat_ws(":", id_col.cast("string"), F.lit(t))), 1, 8), 16, 10).cast("long")
    bits = [F.when(F.pmod(h(t), F.lit(100)) < percent, F.lit(1 << t).cast("long")).otherwise(F.lit(0).cast("long")) for t in range(trials)]
    return sum(bits[1:], bits[0])


def cross_validate(data: DataFrame, tests: Column, k: int, trials: int, percent: int, weight: Column | None = None, **sizes) -> DataFrame:
    """(trial, n, error): per trial the mean squared error of the estimate
    of the held-out rows that ``tests`` admits, from the rows not held out.

    Test rows of all trials are one query table of one join."""
    data = cut_lineage(data.withColumn("held", held_out(F.col("id"), trials, percent)))
    trial = F.explode(F.sequence(F.lit(0), F.lit(trials - 1))).alias("trial")
    asked = (data.where(tests).select("id", "input", "result", "held", trial)
             .where(F.expr("(shiftright(held, trial) & 1) = 1")).select(F.col("id").alias("query_id"), "input", "trial", F.col("result").alias("actual")))
    guess = estimates(nearest_join(data, asked, k, **sizes), weight)
    miss = F.col("actual") - F.col("estimate")
    return (asked.select("query_id", "trial", "actual").join(guess, ["query_id", "trial"])
            .groupBy("trial").agg(F.count(F.lit(1)).alias("n"), F.avg(miss * miss).alias("error")))
