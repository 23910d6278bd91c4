"""Kernel sums between rows and a kernel classifier (inventory B12, B13, B16).

``kernel_decisions`` is exact: query rows against all training rows, both sides
dealt into blocks, so that a task holds one block of either; per query and
class a block pair yields one sum, and the sums are added by Spark.

``kernel_offset`` needs the mean kernel of all pairs within each class. A class
mean in the space of random Fourier features stands for its pairs: the mean
over pairs is the squared length of the mean feature vector, so the work is
linear in the rows. ``features`` is the documented parameter of the error,
which falls with its square root.

``RbfClassifier`` is a support vector classifier in that same space: linear in
the rows, with one sum of gradients per task and round.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, CHUNK = 4096, 512


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def kernel_decisions(train: DataFrame, queries: DataFrame, gamma: float = 10.0, offset: float = 0.0,
                     block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, y, predicted) for ``queries`` (query_id, vec): the mean
    RBF kernel to the rows (vec, label) of class 0 less that to class 1, plus
    ``offset``; class 0 if positive. Rows without a vector take no part."""
    train = train.where("vec IS NOT NULL AND label IN (0, 1)").select(F.col("vec").cast("array<double>").alias("vec"), F.col("label").cast("int").alias("label"))
    queries = queries.where("vec IS NOT NULL").select(F.col("query_id").cast("long").alias("query_id"), F.col("vec").cast("array<double>").alias("vec"))
    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    blocks, chunks = -(-sum(sizes.values()) // block) or 1, -(-queries.count() // chunk) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = train.withColumn("a", F.pmod(F.xxhash64("vec", "label"), F.lit(blocks))).withColumn("b", every(chunks))
    right = queries.withColumn("b", F.pmod(F.xxhash64("query_id"), F.lit(chunks))).withColumn("a", every(blocks))

    def add(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(mine) and len(theirs):
            x, one = _stack(mine["vec"]), mine["label"].to_numpy() == 1
            for q, v in zip(theirs["query_id"], _stack(theirs["vec"]), strict=True):
                k = np.exp(-gamma * ((x - v) ** 2).sum(axis=1))
                rows.append((q, k[~one].sum(), k[one].sum()))
        return pd.DataFrame(rows, columns=["query_id", "s0", "s1"]).astype({"query_id": "int64", "s0": "float64", "s1": "float64"})

    sums = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(add, "query_id long, s0 double, s1 double")
    mean = lambda i: F.sum(f"s{i}") / F.lit(float(sizes.get(i, 0) or 1))
    y = sums.groupBy("query_id").agg((mean(0) - mean(1) + F.lit(offset)).alias("y"))
    return y.select("query_id", "y", F.when(F.col("y") > 0, 0).otherwise(1).alias("predicted"))


@dataclass
class FourierMap:
    """Random Fourier features of an RBF kernel: the product of two mapped
    vectors is the kernel up to an error of about 1 / sqrt(features)."""

    turns: np.ndarray
    shift: np.ndarray

    @classmethod
    def of(cls, dim: int, gamma: float, features: int, seed: int) -> FourierMap:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(scale=np.sqrt(2 * gamma), size=(dim, features)), rng.uniform(0, 2 * np.pi, features))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Mapped rows, with a last column of ones for the offset."""
        phi = np.cos(x @ self.turns + self.shift) * np.sqrt(2.0 / len(self.shift))
        return np.concatenate([phi, np.ones((len(x), 1))], axis=1)


def _rows(b: pa.RecordBatch, dim: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of a batch's first column, vectors of ``dim`` numbers."""
    x = b.column(0).flatten().to_numpy().reshape(b.num_rows, dim)
    for at in range(0, len(x), 1024):
        yield slice(at, at + 1024), x[at:at + 1024]


@dataclass
class RbfClassifier:
    """Labels 0 and 1 by the sign of a weight vector over the map."""

    phi: FourierMap
    weights: np.ndarray

    def predict(self, queries: DataFrame) -> DataFrame:
        """(query_id, decision, predicted) of rows (query_id, vec); rows
        without a vector, or with one of another length, are left out."""
        phi, weights = self.phi, self.weights
        dim = len(phi.turns)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                y = np.concatenate([phi(x) @ weights for _, x in _rows(b, dim)] or [np.empty(0)])
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array(y)], ["query_id", "decision"])

        rows = queries.where(F.size("vec") == dim).select(F.col("vec").cast("array<double>").alias("vec"), F.col("query_id").cast("long").alias("query_id"))
        return rows.mapInArrow(run, "query_id long, decision double").select("query_id", "decision", F.when(F.col("decision") > 0, 1).otherwise(0).alias("predicted"))


def train_rbf(train: DataFrame, gamma: float = 10.0, cost: float = 10.0, features: int = 512, rounds: int = 40, seed: int = 42,
              state: str | None = None, save_every: int = 10) -> RbfClassifier:
    """Fit B16 on rows (vec, label), labels 0 and 1, all vectors of one length.

    Minimises |w|^2 / (2 cost n) plus the mean of the squared hinge loss by
    accelerated gradient steps of a fixed, safe length. A round is one scan:
    every task adds up the gradient of its rows, Spark adds up the tasks'
    gradients, and ``features`` + 1 numbers reach the driver. With ``state`` the
    weights are written to that folder every ``save_every`` rounds, and a run
    that finds some there goes on from the latest. An empty table gives weights
    of zero."""
    rows = train.where("label IN (0, 1) AND size(vec) > 0").select(F.col("vec").cast("array<double>").alias("vec"), F.col("label").cast("int").alias("label"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    n, dim = size["n"], size["dim"] or 0
    phi = FourierMap.of(dim, gamma, features, seed)
    spark = train.sparkSession
    at, w, ahead = 0, np.zeros(features + 1), np.zeros(features + 1)
    if state and (saved := _latest(spark, state)):
        at, w, ahead = saved["round"], np.array(saved["weights"]), np.array(saved["ahead"])
    ridge = np.append(np.full(features, 1.0 / (cost * max(n, 1))), 0.0)  # the offset is free
    step = 1.0 / (6.0 + ridge[0])  # a mapped row has a squared length of 3 at most, and the loss twice its curvature
    for k in range(at, rounds if n else at):
        def gradient(batches: Iterable[pa.RecordBatch], v: np.ndarray = ahead) -> Iterator[pa.RecordBatch]:
            total = np.zeros(features + 1)
            for b in batches:
                y = 2.0 * b.column(1).to_numpy() - 1.0
                for part, x in _rows(b, dim):
                    m = phi(x)
                    total += m.T @ (-2.0 * y[part] * np.maximum(0.0, 1.0 - y[part] * (m @ v)))
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["g"])

        sums = rows.mapInArrow(gradient, "g array<double>").select(F.posexplode("g").alias("pos", "g")).groupBy("pos").agg(F.sum("g").alias("g")).collect()
        g = np.zeros(features + 1)
        for r in sums:
            g[r["pos"]] = r["g"]
        new = ahead - step * (g / n + ridge * ahead)
        w, ahead = new, new + (k / (k + 3.0)) * (new - w)
        if state and (k + 1) % save_every == 0:
            spark.createDataFrame([(k + 1, w.tolist(), ahead.tolist())], "round int, weights array<double>, ahead array<double>").write.mode(
                "overwrite").parquet(os.path.join(state, f"at={k + 1}"))
    return RbfClassifier(phi, w)


def _latest(spark, state: str):
    """The last weights that a run left in its folder, if any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(state)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(state).orderBy(F.desc("round")).first()


def kernel_offset(train: DataFrame, gamma: float = 10.0, features: int = 2048, seed: int = 42) -> float:
    """Mean RBF kernel over the pairs of class 1 less that of class 0,
    self-pairs included, of rows (vec, label)."""
    train = train.where("vec IS NOT NULL AND label IN (0, 1)").select(F.col("vec").cast("array<double>").alias("vec"), F.col("label").cast("int").alias("label"))
    first = train.select(F.size("vec").alias("n")).first()
    if first is None:
        return 0.0
    rng = np.random.default_rng(seed)
    turns, shift = rng.normal(scale=np.sqrt(2 * gamma), size=(first["n"], features)), rng.uniform(0, 2 * np.pi, features)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, features)), [0, 0]
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            label = b.column(1).to_numpy()
            for at in range(0, len(x), 1024):
                phi = np.cos(x[at:at + 1024] @ turns + shift)
                for c in (0, 1):
                    total[c] += phi[label[at:at + 1024] == c].sum(axis=0)
                    n[c] += int((label[at:at + 1024] == c).sum())
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(total)), pa.array(n, pa.int64())], ["label", "sums", "n"])

    parts = train.mapInArrow(sums, "label int, sums array<double>, n long")
    whole = parts.select("label", "n", F.posexplode("sums").alias("pos", "v")).groupBy("label", "pos").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    mean = {r["label"]: r["m"] for r in whole.where("n > 0").groupBy("label").agg(
        F.sum((F.col("v") / F.col("n")) * (F.col("v") / F.col("n")) * F.lit(2.0 / features)).alias("m")).collect()}
    return mean.get(1, 0.0) - mean.get(0, 0.0)
