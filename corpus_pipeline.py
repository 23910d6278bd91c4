"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and works on
all rows that its predecessor kept. All but the last return the columns of
``documents``; ``run`` writes each stage's result to the shared folder and
reads it back as the next one's input.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, kneser_ney, line_dedup, packing, simhash
from quarry.llm.common import fits_broadcast, hashed_key, scratch_path, table
from quarry.llm.queries import END_ID, MIN_SITES, WINDOW, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier accepts.

    Null and empty texts are rejected (they have no perplexity). Nulls in other
    columns, long texts and tables without labels: see ``kneser_ney``. Repeated
    rows are judged alike, an empty table stays empty, and columns other than
    those of ``documents`` are dropped, here and in every stage but the last."""
    judged = kneser_ney.classify(docs, table(spark, sf_dir, "labels"))
    bad = judged.where("NOT kept").select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct()
    k1, k2 = hashed_key(F.col("doc_id"), F.col("text"))
    return (docs.withColumns({"__k1": k1, "__k2": k2}).join(fits_broadcast(bad, 64, 16 << 20), ["__k1", "__k2"], "left_anti")
            .select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; those of which nothing is left go.

    Null texts, and texts of which no line was removed, stay as they are. A
    null source is no site; blank lines are never removed. Repeated rows lose
    the same lines; an empty table stays empty."""
    out = line_dedup.remove(docs, MIN_SITES)
    left = F.col("n_removed").eqNullSafe(0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = out.where(F.coalesce(left, F.lit(True)))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Texts without a word share the fingerprint zero and count as duplicates of
    each other; of a group the smallest id stays, of repeated rows one. Null
    ids come last."""
    return simhash.keep_one(docs, shingle=3, max_bits=3).select(*COLUMNS)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item.

    Null and wordless texts overlap none and stay; items of fewer than five
    words match nothing. Repeated rows go or stay together."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in training sequences.

    A null text is its end token alone; long texts are cut, ties go by the
    row's key, repeated rows are packed each, an empty table gives no piece."""
    cut = packing.pieces(docs, tokenizer_path(), WINDOW, END_ID)
    return packing.pack(cut, WINDOW).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", contamination), ("packing", sequences)]

#: SQL can state neither the language model, the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        path = os.path.join(folder, str(i))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
