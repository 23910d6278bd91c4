"""Tables laid out as streams of several micro-batches."""

from pyspark.sql import functions as F

from quarry.plans import q_streaming as Q
from quarry.streaming import ops as ST


def test_a_range_is_several_files_and_one_micro_batch(spark, tmp_path, monkeypatch):
    """One task read and wrote a whole range before."""
    df = spark.range(90).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang")).repartition(5)
    paths, made = set(), ST.file_stream
    monkeypatch.setattr(ST, "file_stream", lambda spark, path, *rest: paths.add(path) or made(spark, path, *rest))
    out = spark.read.parquet(Q._fed(spark, df, "doc_id", "fed", lambda s: ST.snapshots(s, ["lang"], f"{tmp_path}/out")))
    got = {(r["snapshot"], r["lang"]): r["n"] for r in out.collect()}
    assert got == {(b, lang): 15 for b in range(Q.BATCHES) for lang in ("en", "de")}
    assert len(spark.read.parquet(paths.pop()).inputFiles()) > Q.BATCHES


def test_a_range_without_rows_is_a_batch_of_its_own(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (29, "b")], "doc_id long, lang string")
    out = spark.read.parquet(Q._fed(spark, df, "doc_id", "fed", lambda s: ST.snapshots(s, ["lang"], f"{tmp_path}/out")))
    assert {(r["snapshot"], r["lang"], r["n"]) for r in out.collect()} == {(0, "a", 2), (2, "b", 1)}
