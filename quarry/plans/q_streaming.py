"""Registered queries: streaming operators over the documents, laid out as a
table of several files so that a stream runs several micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.plans.q_classify import _BASE_SQL
from quarry.plans.q_relational import wordset_sql
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.tables import Tables
from quarry.streaming import ops as ST

TERMS = "chouou, thorreou"
BATCHES = 3


def _path(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _fed(spark, df, key: str, name: str, run) -> str:
    """The output of ``run`` over the whole table as a stream of BATCHES
    micro-batches by ranges of its key. The files of a range, as many as the
    table's scan has tasks, are added to the stream's folder, and ``run``, which
    goes on where it stopped, takes all that are new as one micro-batch."""
    path = _path(spark, name)
    low, high = df.agg(F.min(key), F.max(key)).first()
    part = F.floor((F.col(key) - F.lit(low)) * BATCHES / F.lit(high - low + 1))
    for i in range(BATCHES):
        df.where(part == i).write.mode("append").parquet(path)
        out = run(ST.file_stream(spark, path, df.schema, None))
    return out


def _doc_fed(spark, sf, run):
    return _fed(spark, Tables(spark, sf).documents, "doc_id", "stream", run)


@register("st1_keyword_stream", sql="""SELECT doc_id FROM documents
WHERE contains(lower(text), 'chouou') OR contains(lower(text), 'thorreou')""")
def st1(spark, sf):
    """Documents whose text holds a tracked term, from a file stream."""
    to = _path(spark, "st1")
    out = _doc_fed(spark, sf, lambda stream: ST.run_available(ST.keyword_filter(stream, "text", TERMS).select("doc_id"), to))
    return spark.read.parquet(out)


@register("st2_snapshots", sql=f"""WITH r AS (SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM documents)
SELECT floor((doc_id - lo) * {BATCHES} / (hi - lo + 1))::INT AS snapshot, lang, count(*) AS n FROM documents, r GROUP BY ALL""")
def st2(spark, sf):
    """A snapshot of documents per language for every micro-batch."""
    to = _path(spark, "st2")
    out = _doc_fed(spark, sf, lambda stream: ST.snapshots(stream, ["lang"], to))
    return spark.read.parquet(out).select("snapshot", "lang", "n")


@register("st2_interval_snapshots", sql="""WITH d AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS snapshot, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT * FROM d WHERE snapshot + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def st2_intervals(spark, sf):
    """Events per type of every whole day, an hour after the day is over, from
    a stream of files in the order of the events."""
    # the table's times have no zone, and a watermark needs instants: read as UTC whatever the session's zone
    instant = F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts))").alias("ts")
    e = Tables(spark, sf).events.select("event_id", instant, "event_type")
    to = _path(spark, "st2i")
    out = spark.read.parquet(_fed(spark, e, "event_id", "events", lambda stream: ST.interval_snapshots(stream, "ts", "1 day", ["event_type"], to, late="1 hour")))
    return out.withColumn("snapshot", F.expr("timestampadd(SECOND, cast(unix_seconds(snapshot) AS int), TIMESTAMP_NTZ'1970-01-01 00:00:00')"))


@register("st3_incremental_training", sql=f"WITH {_BASE_SQL} SELECT feature, cat, n FROM fc")
def st3(spark, sf):
    """Classifier counts trained batch by batch from a document stream;
    equal to the batch counts (a17)."""
    t = Tables(spark, sf)
    to = _path(spark, "st3")
    path = _doc_fed(spark, sf, lambda stream: ST.incremental_counts(ST.labelled_word_sets(stream, t.labels), "fs", "cat", to))
    return ST.merged_counts(spark, path)[0]


def _st4_sql() -> str:
    out = [f"""r AS (SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM documents),
i AS (SELECT floor((doc_id - lo) * {BATCHES} / (hi - lo + 1))::INT AS b, d.doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS cat, {wordset_sql('d.text')} AS fs
  FROM documents d JOIN labels l USING (doc_id), r),
f AS (SELECT b, doc_id, cat, unnest(fs) AS feature FROM i)"""]
    picks = ["SELECT doc_id, 'unknown' AS category FROM i WHERE b = 0"]
    for b in range(1, BATCHES):
        out.append(f"""c{b} AS (SELECT count(*) FILTER (cat = 'bad') AS cb, count(*) FILTER (cat = 'good') AS cg, count(*) AS n FROM i WHERE b < {b}),
t{b} AS (SELECT feature, count(*) FILTER (cat = 'bad') AS nb, count(*) FILTER (cat = 'good') AS ng FROM f WHERE b < {b} GROUP BY 1),
w{b} AS (SELECT feature, (0.5 + (nb + ng) * (nb / cb)) / (1 + nb + ng) AS wb, (0.5 + (nb + ng) * (ng / cg)) / (1 + nb + ng) AS wg FROM t{b}, c{b}),
s{b} AS (SELECT i.doc_id, coalesce(sum(ln(coalesce(wb, 0.5))) FILTER (f.feature IS NOT NULL), 0.0) AS sb, coalesce(sum(ln(coalesce(wg, 0.5))) FILTER (f.feature IS NOT NULL), 0.0) AS sg
  FROM i LEFT JOIN f ON f.doc_id = i.doc_id LEFT JOIN w{b} ON w{b}.feature = f.feature WHERE i.b = {b} GROUP BY 1)""")
        picks.append(f"SELECT doc_id, CASE WHEN sb + ln(cb / n) >= sg + ln(cg / n) THEN 'bad' ELSE 'good' END FROM s{b}, c{b}")
    return f"WITH {', '.join(out)} {' UNION ALL '.join(picks)}"


@register("st4_classify_and_train", sql=_st4_sql())
def st4(spark, sf):
    """Every labelled document classified with what the batches before its own
    taught, then learnt."""
    t = Tables(spark, sf)
    to = _path(spark, "st4")
    out = _doc_fed(spark, sf, lambda stream: ST.classify_and_train(ST.labelled_word_sets(stream, t.labels), "doc_id", "fs", "cat", to))
    return spark.read.parquet(f"{out}/decided").select("doc_id", "category")
