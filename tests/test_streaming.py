"""Streams over folders that grow between runs."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.streaming import ops as ST

ROWS = [(1, "alpha beta", "good"), (2, "beta gamma", "bad"), (3, "alpha delta", "good"), (4, "gamma delta", "bad"), (5, "alpha gamma", "good")]


def add(spark, path, rows):
    (spark.createDataFrame(rows, "id int, text string, cat string").select("id", "text", "cat", T.word_set("text").alias("fs"))
     .coalesce(1).write.mode("append").parquet(path))


def schema(spark):
    return spark.createDataFrame([], "id int, text string, cat string, fs array<string>").schema


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    add(spark, src, ROWS[:2])
    run = lambda: ST.run_available(ST.keyword_filter(ST.file_stream(spark, src, schema(spark)), "text", "ALPHA, gamma").select("id"), out)
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]
    add(spark, src, ROWS[2:])
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5]


def test_counts_over_several_batches_and_a_second_run(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for r in ROWS[:3]:
        add(spark, src, [r])
    ST.incremental_counts(ST.file_stream(spark, src, schema(spark)), "fs", "cat", out)
    assert spark.read.parquet(f"{out}/fc").select("batch_id").distinct().count() == 3
    add(spark, src, ROWS[3:])
    ST.incremental_counts(ST.file_stream(spark, src, schema(spark)), "fs", "cat", out)
    fc, cc = ST.merged_counts(spark, out)
    assert {(r["feature"], r["cat"]): r["n"] for r in fc.collect()}[("alpha", "good")] == 3
    assert {r["cat"]: r["n"] for r in cc.collect()} == {"good": 3, "bad": 2}


def test_classify_then_learn(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for part in (ROWS[:2], ROWS[2:4], ROWS[4:]):
        add(spark, src, part)
    ST.classify_and_train(ST.file_stream(spark, src, schema(spark)), "id", "fs", "cat", out)
    got = {r["id"]: r["category"] for r in spark.read.parquet(f"{out}/decided").collect()}
    assert got[1] == got[2] == "unknown" and got[3] == "good" and got[4] == "bad" and set(got) == {1, 2, 3, 4, 5}


def test_snapshots(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for part in (ROWS[:3], ROWS[3:]):
        add(spark, src, part)
    ST.snapshots(ST.file_stream(spark, src, schema(spark)), ["cat"], out)
    got = {(r["snapshot"], r["cat"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {(0, "good"): 2, (0, "bad"): 1, (1, "good"): 1, (1, "bad"): 1}
    assert spark.read.parquet(out).where(F.col("taken_at").isNull()).count() == 0


@pytest.mark.parametrize("files", [1, 5])
def test_table_folder_as_source(spark, tmp_path, files):
    src = f"{tmp_path}/table.parquet"
    add(spark, src, ROWS)
    s = ST.file_stream(spark, src, schema(spark), files)
    out = ST.run_available(s.select("id"), f"{tmp_path}/out")
    assert spark.read.parquet(out).count() == 5


def test_interval_snapshots_wait_for_late_rows_and_go_on_after_a_restart(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def put(*rows):
        (spark.createDataFrame(rows, "ts string, kind string").select(F.col("ts").cast("timestamp").alias("ts"), "kind")
         .coalesce(1).write.mode("append").parquet(src))
        schema = spark.read.parquet(src).schema
        ST.interval_snapshots(ST.file_stream(spark, src, schema), "ts", "10 minutes", ["kind"], out, late="5 minutes")
        return sorted((r["snapshot"].strftime("%H:%M"), r["kind"], r["n"]) for r in spark.read.parquet(out).collect())

    day = "2024-01-01 "
    assert put((day + "10:01:00", "a"), (day + "10:11:00", "a"), (None, "a")) == []   # 10:00 is open until 10:15 is seen
    # late by less than five minutes behind the latest: counted; stream restarted in between
    assert put((day + "10:08:00", "a"), (day + "10:09:00", "b"), (day + "10:16:00", "b")) == [("10:00", "a", 2), ("10:00", "b", 1)]
    got = put((day + "10:05:00", "a"), (day + "10:26:00", "a"))                       # 10:00 is over: the late row is dropped
    assert got == [("10:00", "a", 2), ("10:00", "b", 1), ("10:10", "a", 1), ("10:10", "b", 1)]


def test_snapshots_at_an_interval_of_the_clock(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    add(spark, src, ROWS[:2])
    add(spark, src, ROWS[2:])
    ST.snapshots(ST.file_stream(spark, src, schema(spark)), ["cat"], out, every="1 second", seconds=8)
    taken = spark.read.parquet(out)
    assert taken.agg(F.sum("n")).first()[0] == 5 and taken.select("taken_at").distinct().count() == 2
