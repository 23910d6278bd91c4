"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import cut_lineage, scratch_path

__all__ = ["WORD_RE", "cut_lineage", "fits_broadcast", "hashed_key", "lower_ascii", "map_frames",
           "scratch_path", "table", "words"]

# A word is a run of characters other than ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def words(col: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(WORD_RE), F.lit(0))


def hashed_key(*cols: Column | str) -> list[Column]:
    """Two 64-bit hashes that stand for a row's values in equi-joins.

    Never null, so rows with a null id keep an identity of their own (their
    text). Equal rows share a key."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit("2"), *cols)]


def fits_broadcast(df: DataFrame, row_bytes: int, max_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows, counted first, take at most
    ``max_bytes``; above that it stays as it is and joins by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df


def map_frames(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInPandas that skips empty batches. ``fn``: one frame to one frame."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield fn(frame)

    return df.mapInPandas(run, schema)
