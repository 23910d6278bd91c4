"""Structured Streaming operators (inventory ST1-ST4).

Streams read files as they arrive (``readStream``).  Results and state live in
a folder that the caller names: run again with the same folder, a stream goes
on where it stopped; a batch that is replayed after a failure replaces what it
wrote before.  ``availableNow`` triggers process what is present and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T


def keyword_filter(stream: DataFrame, col: str, terms: str) -> DataFrame:
    """ST1: records whose ``col`` contains any of the comma-separated terms
    (case-insensitive, literal match)."""
    words = [t.strip().lower() for t in terms.split(",") if t.strip()]
    cond = F.lit(False)
    for w in words:
        cond = cond | F.lower(F.col(col)).contains(w)
    return stream.where(cond)


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = 1) -> DataFrame:
    """A parquet file stream over a table folder (or over one file's folder by
    a glob in ``path``); ``max_files`` new files make a micro-batch, all that
    are new if it is None."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def _run(writer, out: str, every: str | None, seconds: float | None) -> str:
    """Start a stream whose progress is kept beside ``out``. Without ``every``
    it takes what is present and ends; with it a micro-batch starts at that
    interval, and the stream is stopped after ``seconds``, if given."""
    when = {"processingTime": every} if every else {"availableNow": True}
    q = writer.option("checkpointLocation", out + "-progress").trigger(**when).start()
    try:
        q.awaitTermination(seconds) if every and seconds else q.awaitTermination()
    finally:
        q.stop()
    return out


def run_available(df: DataFrame, out: str, fmt: str = "parquet", every: str | None = None, seconds: float | None = None) -> str:
    """Run a streaming DataFrame over the data present, adding to the table
    ``out``; the progress is kept beside it, so a second run adds only what
    is new. ``every`` and ``seconds``: run at an interval instead."""
    return _run(df.writeStream.format(fmt).option("path", out), out, every, seconds)


def _each_batch(stream: DataFrame, out: str, work, every: str | None = None, seconds: float | None = None) -> str:
    return _run(stream.writeStream.foreachBatch(work), out, every, seconds)


def _batch_counts(batch: DataFrame, batch_id: int, features: str, cat: str, out: str) -> None:
    fc = (batch.select(F.explode(F.array_distinct(features)).alias("feature"), F.col(cat).alias("cat"))
          .groupBy("feature", "cat").agg(F.count(F.lit(1)).alias("n")))
    fc.write.mode("overwrite").parquet(f"{out}/fc/batch_id={batch_id}")
    cc = batch.groupBy(F.col(cat).alias("cat")).agg(F.count(F.lit(1)).alias("n"))
    cc.write.mode("overwrite").parquet(f"{out}/cc/batch_id={batch_id}")


def incremental_counts(stream: DataFrame, features: str, cat: str, out: str) -> str:
    """ST3: feature / category counts kept batch by batch under ``out``.

    Each micro-batch's counts go to the partition ``batch_id=<id>`` with
    overwrite, so a replayed batch replaces its own counts instead of adding
    them twice.  ``merged_counts`` gives (feature, cat, n)."""
    return _each_batch(stream, out, lambda batch, i: _batch_counts(batch, i, features, cat, out))


def merged_counts(spark: SparkSession, path: str, before: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The sum of the batches' counts, of those before batch ``before`` if
    given."""
    parts = []
    for name, keys in (("fc", ["feature", "cat"]), ("cc", ["cat"])):
        df = spark.read.parquet(f"{path}/{name}")
        if before is not None:
            df = df.where(F.col("batch_id") < before)
        parts.append(df.groupBy(*keys).agg(F.sum("n").alias("n")))
    return parts[0], parts[1]


def classify_and_train(stream: DataFrame, key: str, features: str, cat: str, out: str, default: str = "unknown") -> str:
    """ST4: each micro-batch is first classified with the counts of the
    batches before it and then learnt from.  Decisions (key, category) go to
    ``out``/decided, by batch; the first batch, with nothing learnt, gets
    ``default``."""
    from quarry.operators import classify as C

    def work(batch: DataFrame, i: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()   # classified, counted twice; released below
        if i == 0:
            got = batch.select(key, F.lit(default).alias("category"))
        else:
            fc, cc = merged_counts(spark, out, i)
            got = C.nb_classify(batch, key, features, fc, cc, None, default)
        got.write.mode("overwrite").parquet(f"{out}/decided/batch_id={i}")
        _batch_counts(batch, i, features, cat, out)
        batch.unpersist()

    return _each_batch(stream, out, work)


def snapshots(stream: DataFrame, by: list[str], out: str, every: str | None = None, seconds: float | None = None) -> str:
    """ST2: a snapshot of counts per micro-batch, under ``snapshot=<id>`` with
    the time it was taken. ``every`` ('60 seconds') makes that a snapshot per
    interval of the clock, for ``seconds`` or until stopped; without it each
    batch of what is present is one."""

    def work(batch: DataFrame, i: int) -> None:
        n = batch.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("taken_at", F.current_timestamp())
        n.write.mode("overwrite").parquet(f"{out}/snapshot={i}")

    return _each_batch(stream, out, work, every, seconds)


def interval_snapshots(stream: DataFrame, time: str, interval: str, by: list[str], out: str, late: str = "0 seconds",
                       every: str | None = None, seconds: float | None = None) -> str:
    """ST2 by event time: rows (snapshot, *by, n), the counts of each whole
    ``interval`` of the rows' own ``time``, added to the table ``out`` once the
    interval is over.

    Counts of open intervals are kept in the state store. An interval is over
    when the watermark, the latest time seen in the batches before less
    ``late``, has passed its end: rows that come up to ``late`` behind the
    latest are counted, rows of an interval that is over are dropped, and rows
    without a time belong to none. A stream that is started again with the same
    folder goes on with the state that it had."""
    counts = (stream.withWatermark(time, late).groupBy(F.window(time, interval).alias("w"), *by)
              .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("snapshot"), *by, "n"))
    return run_available(counts, out, every=every, seconds=seconds)


def labelled_word_sets(stream: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of a stream joined with their (static) labels, as word
    sets and 'good' / 'bad' categories (stream-static join)."""
    return (stream.join(labels, "doc_id")
            .select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("cat"),
                    T.word_set("text").alias("fs")))
