"""Landmark form of scaling to two dimensions (inventory C8).

``k`` landmarks are chosen over all rows, each the row farthest from those
before it. Their k x k squared distances are scaled classically on the driver
(its size is the parameter k, not the data's); every other row is placed by one
projection of its squared distances to the landmarks. Work is k distances a
row and pass, and rows never meet each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _squares(batch: pa.RecordBatch, marks: np.ndarray) -> np.ndarray:
    """Squared distances of a batch's vectors (column 1) to the landmarks."""
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
    return np.stack([((x - m) ** 2).sum(axis=1) for m in marks], axis=1)


def landmarks(rows: DataFrame, k: int) -> np.ndarray:
    """At most ``k`` vectors of ``rows`` (id, vec), by farthest-point choice;
    fewer if there are fewer different vectors. Ties go to the smaller id."""
    first = rows.orderBy(F.xxhash64("id"), "id").limit(1).collect()
    marks = [np.array(r["vec"], np.float64) for r in first]
    while marks and len(marks) < k:
        so_far = np.array(marks)

        def farthest(batches: Iterable[pa.RecordBatch], so_far: np.ndarray = so_far) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    far = np.round(_squares(b, so_far).min(axis=1), 9)
                    best = np.flatnonzero(far == far.max())
                    at = best[np.argmin(b.column(0).to_numpy()[best])]
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 1), b.column(1).slice(at, 1), pa.array(far[at:at + 1])], ["id", "vec", "far"])

        best = rows.mapInArrow(farthest, "id long, vec array<double>, far double").agg(
            F.max_by(F.struct("vec", "far"), F.struct("far", -F.col("id"))).alias("x")).first()["x"]
        if best["far"] <= 0:
            break
        marks.append(np.array(best["vec"], np.float64))
    return np.array(marks)


def landmark_scaling(rows: DataFrame, id_col: str, vec: str, k: int = 24, dims: int = 2) -> DataFrame:
    """(id, place array<double>), ``dims`` coordinates of every row with a
    vector; axes by falling share of the landmarks' spread, the first nonzero
    large loading positive. Fewer dimensions than asked for are padded with 0."""
    rows = rows.where(F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    marks = landmarks(rows, k)
    schema = "id long, place array<double>"
    if not len(marks):
        return rows.sparkSession.createDataFrame([], schema)
    square = ((marks[:, None] - marks[None]) ** 2).sum(axis=2)
    mean = square.mean(axis=0)
    values, vectors = np.linalg.eigh(-0.5 * (square - mean - mean[:, None] + square.mean()))
    top = np.argsort(-values)[:dims]
    top = top[values[top] > 1e-9 * max(values.max(), 1e-300)]
    axes = vectors[:, top]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    project = np.zeros((len(marks), dims))
    project[:, :len(top)] = -0.5 * axes / np.sqrt(values[top])

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = (_squares(b, marks) - mean) @ project
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(at))], ["id", "place"])

    return rows.mapInArrow(place, schema)
