"""Registered queries: report compositions over conversations, events and
orders (content, likes and vocabulary reports)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import relational as Rel
from quarry.plans.registry import register
from quarry.sources.tables import PREFS_SQL, Tables

_WS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"


@register("h2_content_report", sql=f"""WITH t AS (SELECT role, {_WS} AS w FROM conversations),
u AS (SELECT role, unnest(w) AS word FROM t)
SELECT t.role, d.diversity, avg(len(t.w)) AS avg_words FROM t JOIN (
  SELECT role, count(DISTINCT word) / count(word) AS diversity FROM u GROUP BY 1) d USING (role)
GROUP BY t.role, d.diversity""")
def h2(spark, sf):
    """Per speaker role: lexical diversity of all turns and mean words per turn."""
    c = Tables(spark, sf).conversations.select("role", T.ws_tokens("text").alias("w"))
    div = Rel.lexical_diversity(c.select("role", F.explode("w").alias("word")), "role")
    avg = c.groupBy("role").agg(F.avg(F.size("w")).alias("avg_words"))
    return div.join(avg, "role").select("role", "diversity", "avg_words")


@register("h10_likes_report", sql=f"""WITH {PREFS_SQL}
SELECT item_id, count(*) AS n FROM prefs GROUP BY 1 ORDER BY n DESC, item_id ASC LIMIT 10""")
def h10(spark, sf):
    """The ten parts bought by the most customers (frequency report)."""
    return Rel.frequency(Tables(spark, sf).prefs(), "item_id", 10)


@register("a27_vocabulary_stats", sql=f"""WITH t AS (SELECT unnest({_WS}) AS w FROM documents),
v AS (SELECT DISTINCT w FROM t)
SELECT count(*) FILTER (WHERE starts_with(w, 'http')) AS url_tokens,
       count(*) FILTER (WHERE length(w) > 15 AND NOT starts_with(w, 'http')) AS long_words,
       count(*) AS vocabulary FROM v""")
def a27(spark, sf):
    """Distinct whitespace tokens of the documents: URL-like, long non-URL, all."""
    v = Tables(spark, sf).documents.select(F.explode(T.ws_tokens("text")).alias("w")).distinct()
    return v.agg(F.count_if(F.col("w").startswith("http")).alias("url_tokens"),
                 F.count_if((F.length("w") > 15) & ~F.col("w").startswith("http")).alias("long_words"),
                 F.count(F.lit(1)).alias("vocabulary"))


@register("h8_title_token_distribution", sql=r"""WITH t AS (
  SELECT unnest(list_filter(regexp_split_to_array(trim(p_name), '\s+'), lambda x: x <> '')) AS tok FROM part),
c AS (SELECT upper(substr(trim(tok, ','), 1, 1)) || lower(substr(trim(tok, ','), 2)) AS token FROM t)
SELECT token, count(*) AS n FROM c GROUP BY token HAVING count(*) > 1 AND length(token) > 2""")
def h8(spark, sf):
    """Capitalised title tokens (commas stripped) used more than once and
    longer than two characters, over part names."""
    t = Tables(spark, sf).part.select(F.explode(T.title_tokens("p_name")).alias("token"))
    c = t.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return c.where((F.col("n") > 1) & (F.length("token") > 2))
