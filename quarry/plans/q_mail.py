"""Registered queries: mail reports over messages made of the events table:
sender and recipients (to, cc) are arrays as a mail store keeps them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import relational as Rel
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import files as IO
from quarry.sources.tables import Tables

SENDER = "concat('u', user_id % 40, '@', event_type, '.example')"
TO = "concat('u', event_id % 60, '@click.example,', ' u', user_id % 9, '@view.example')"
CC = "CASE WHEN event_id % 3 = 0 THEN concat('u', user_id % 13, '@error.example') END"
DOMAIN = "error.example"
PERSON = r"^u7@"

_MAIL_SQL = f"""mail AS (SELECT event_id, {SENDER} AS sender, string_split(replace({TO}, ' ', ''), ',') AS "to",
  CASE WHEN event_id % 3 = 0 THEN [{CC}] END AS cc FROM events),
send AS (SELECT DISTINCT sender AS a FROM mail),
recv AS (SELECT unnest("to") AS a FROM mail UNION SELECT unnest(cc) FROM mail)"""


def _mail(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", F.expr(SENDER).alias("sender"), T.recipients(F.expr(TO)).alias("to"),
                    F.when(F.expr(CC).isNotNull(), F.array(F.expr(CC))).alias("cc"))


@register("f21_recipients", sql=f"""WITH {_MAIL_SQL} SELECT event_id, array_to_string("to", '|') AS recipients FROM mail""")
def f21(spark, sf):
    """Recipient lists cut at commas, white space removed."""
    return _mail(spark, sf).select("event_id", F.array_join("to", "|").alias("recipients"))


@register("h5_sender_receiver_report", sql=f"""WITH {_MAIL_SQL},
p AS (SELECT 'senders' AS part, a FROM send UNION ALL SELECT 'receivers', a FROM recv
  UNION ALL SELECT 'both', a FROM (SELECT a FROM send INTERSECT SELECT a FROM recv)
  UNION ALL SELECT 'senders_only', a FROM (SELECT a FROM send EXCEPT SELECT a FROM recv)
  UNION ALL SELECT 'receivers_only', a FROM (SELECT a FROM recv EXCEPT SELECT a FROM send))
SELECT part, count(*) AS n, count(*) FILTER (contains(lower(a), '{DOMAIN}')) AS n_domain FROM p GROUP BY part""")
def h5(spark, sf):
    """Distinct senders, receivers, their intersection and both differences,
    in all and of one domain."""
    m = _mail(spark, sf)
    send = m.select(F.col("sender").alias("a")).distinct()
    recv = m.select(F.explode("to").alias("a")).union(m.select(F.explode("cc").alias("a"))).distinct()
    flags = (send.withColumn("s", F.lit(1)).join(recv.withColumn("r", F.lit(1)), "a", "full_outer"))
    parts = F.array_compact(F.array(
        F.when(F.col("s") == 1, "senders"), F.when(F.col("r") == 1, "receivers"), F.when((F.col("s") == 1) & (F.col("r") == 1), "both"),
        F.when(F.col("r").isNull(), "senders_only"), F.when(F.col("s").isNull(), "receivers_only")))
    rows = flags.select("a", F.explode(parts).alias("part"))
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.lower("a").contains(DOMAIN)).alias("n_domain"))


@register("h6_recipients_of_sender", sql=f"""WITH {_MAIL_SQL},
x AS (SELECT sender, unnest("to") AS r FROM mail WHERE regexp_matches(lower(sender), '{PERSON}')
      UNION SELECT sender, unnest(cc) FROM mail WHERE regexp_matches(lower(sender), '{PERSON}'))
SELECT sender, array_to_string(list_sort(list(DISTINCT r)), ' ') AS recipients, count(DISTINCT r) AS n FROM x GROUP BY sender""")
def h6(spark, sf):
    """Everyone that the senders matching a name wrote to, sorted."""
    m = Rel.iregex_filter(_mail(spark, sf), "sender", PERSON)
    r = m.select("sender", F.explode(F.concat("to", F.coalesce("cc", F.array().cast("array<string>")))).alias("r"))
    out = Rel.sorted_set_per_key(r, "sender", "r")
    return out.select("sender", F.array_join("values", " ").alias("recipients"), F.size("values").alias("n"))


@register("h6_list_lengths", sql=f"""WITH {_MAIL_SQL}
SELECT len("to") + coalesce(len(cc), 0) AS n_recipients, count(*) AS n FROM mail WHERE regexp_matches(lower(sender), '{PERSON}') GROUP BY 1""")
def h6l(spark, sf):
    """How many messages of those senders had how many recipients."""
    m = Rel.iregex_filter(_mail(spark, sf), "sender", PERSON)
    n = F.size("to") + F.coalesce(F.size("cc"), F.lit(0))
    return m.select(F.when(F.col("cc").isNull(), F.size("to")).otherwise(n).alias("n_recipients")).groupBy("n_recipients").agg(F.count(F.lit(1)).alias("n"))


@register("f22_mail_dates", sql="""SELECT event_id, epoch_ms(date_trunc('second', ts)) - (event_id % 5 - 2) * 3600000 AS epoch_ms FROM events""")
def f22(spark, sf):
    """Mail date strings with offsets as milliseconds since 1970."""
    e = Tables(spark, sf).events
    offset = F.expr("concat(CASE WHEN event_id % 5 < 2 THEN '-' ELSE '+' END, lpad(abs(event_id % 5 - 2), 2, '0'), '00')")
    date = F.concat(F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" "), offset)
    return e.select("event_id", T.mail_epoch_ms(date).alias("epoch_ms"))


@register("io11_mbox_round_trip", sql=f"""SELECT {SENDER} AS sender, array_to_string(string_split(replace({TO}, ' ', ''), ','), '|') AS recipients,
  concat('Event ', event_id) AS subject, epoch_ms(date_trunc('second', ts)) AS epoch_ms, concat('type ', event_type, chr(10), 'From here on') AS body FROM events""")
def io11(spark, sf):
    """Events written as an mbox file and read back as messages."""
    e = Tables(spark, sf).events
    stamp = F.date_format("ts", "EEE MMM dd HH:mm:ss yyyy")
    text = F.concat(F.lit("From "), F.expr(SENDER), F.lit(" "), stamp, F.lit("\nFrom: "), F.expr(SENDER), F.lit("\nTo: "), F.regexp_replace(F.expr(TO), ", ", ",\n\t"),
                    F.lit("\nSubject: Event "), F.col("event_id").cast("string"), F.lit("\nDate: "), F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss"),
                    F.lit(" +0000\n\ntype "), F.col("event_type"), F.lit("\nFrom here on\n"))
    path = scratch_path(spark, f"mbox-{uuid.uuid4().hex}")
    e.select(text.alias("value")).write.text(path)
    m = IO.read_mbox(spark, path)
    return m.select(F.col("From").alias("sender"), F.array_join("To", "|").alias("recipients"), F.col("Subject").alias("subject"),
                    F.unix_millis("Date").alias("epoch_ms"), F.rtrim(F.regexp_replace("body", r"\n+$", "")).alias("body"))


@register("io12_mail_json_lines", sql=f"""SELECT {SENDER} AS sender, 2 AS n_to, epoch_ms(date_trunc('second', ts)) AS epoch_ms FROM events""")
def io12(spark, sf):
    """Mail as JSON lines: written with array recipients and epoch dates, read
    with a schema."""
    e = Tables(spark, sf).events
    rows = e.select(F.expr(SENDER).alias("From"), T.recipients(F.expr(TO)).alias("To"), F.unix_millis(F.date_trunc("second", "ts")).alias("Date"))
    path = scratch_path(spark, f"mail-json-{uuid.uuid4().hex}")
    IO.write_json(rows, path)
    back = spark.read.schema("From string, To array<string>, Date long").json(path)
    return back.select(F.col("From").alias("sender"), F.size("To").alias("n_to"), F.col("Date").alias("epoch_ms"))


@register("f9_mail_body", sql="SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS body FROM documents")
def f9(spark, sf):
    """Quoted-printable HTML bodies of the documents back to their text."""
    d = Tables(spark, sf).documents
    escaped = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    quoted = F.replace(F.replace(F.replace(escaped, F.lit("="), F.lit("=3D")), F.lit("é"), F.lit("=C3=A9")), F.lit("ü"), F.lit("=c3=BC"))
    body = F.concat(F.lit("<html><body>=\r\n<p>"), F.replace(quoted, F.lit("\n"), F.lit("=\n</p>\n<p>")), F.lit("</p></body></html>"))
    return d.select("doc_id", F.trim(F.regexp_replace(T.mail_body(body), r"\s+", " ")).alias("body"))
