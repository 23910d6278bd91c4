"""Registered queries: message entities and reports, over messages spelled out
of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import social as S
from quarry.plans.registry import register
from quarry.sources.tables import Tables

# The message of an event; the same expression in both dialects.
MESSAGE = """concat(CASE event_id % 4 WHEN 0 THEN concat('RT @U', user_id, ' @u', user_id % 5) WHEN 1 THEN concat('so nice (via @U', user_id % 7, ')')
  ELSE 'no source' END, ' #', event_type, ' #Tag', event_id % 11, ' see http://x.example/', event_id % 20, ' @m', user_id % 3)"""
_MESSAGES_SQL = f"m AS (SELECT event_id, user_id, {MESSAGE} AS text FROM events)"

ENTITIES = """concat('{"user_mentions":[{"screen_name":"m', user_id % 3, '"}],"hashtags":[{"text":"', event_type, '"},{"text":"Tag', event_id % 11,
  '"}],"urls":[', CASE WHEN event_id % 2 = 0 THEN concat('{"url":"http://x.example/', event_id % 20, '"}') ELSE '' END, ']}')"""
_FLAT_SQL = """f AS (SELECT event_id, 'screen_name' AS kind, concat('m', user_id % 3) AS value FROM events
  UNION ALL SELECT event_id, 'hashtag', event_type FROM events
  UNION ALL SELECT event_id, 'hashtag', concat('Tag', event_id % 11) FROM events
  UNION ALL SELECT event_id, 'url', concat('http://x.example/', event_id % 20) FROM events WHERE event_id % 2 = 0)"""


def _messages(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", "user_id", F.expr(MESSAGE).alias("text"), F.expr(ENTITIES).alias("entities"))


def _flat(spark, sf):
    return S.flatten_entities(_messages(spark, sf), "event_id", "entities")


@register("f18_retweet_sources", sql=f"""WITH {_MESSAGES_SQL}
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN array_to_string(list_distinct_in_order, ',') WHEN 1 THEN concat('u', user_id % 7) ELSE '' END AS sources
FROM (SELECT *, CASE WHEN user_id = user_id % 5 THEN [concat('u', user_id)] ELSE [concat('u', user_id), concat('u', user_id % 5)] END AS list_distinct_in_order FROM m)""")
def f18(spark, sf):
    """The accounts that each message names as its source."""
    return _messages(spark, sf).select("event_id", F.array_join(S.retweet_sources(F.col("text")), ",").alias("sources"))


@register("f19_entities", sql=f"""WITH {_MESSAGES_SQL},
p(kind, pat) AS (VALUES ('mention', '@[A-Za-z0-9_]+'), ('url', 'https?://[^\\s]+'), ('hashtag', '#[A-Za-z0-9_]+')),
x AS (SELECT event_id, kind, regexp_extract_all(text, pat) AS v, regexp_split_to_array(text, pat) AS g FROM m, p),
y AS (SELECT *, unnest(v) AS value, unnest(range(1, len(v) + 1)) AS i FROM x)
SELECT event_id, kind, value, list_sum(list_transform(g[1:i], lambda s: length(s)))
  + coalesce(list_sum(list_transform(v[1:i - 1], lambda s: length(s))), 0) AS start FROM y""")
def f19(spark, sf):
    """Mentions, URLs and hashtags of every message with their places."""
    return S.entities(_messages(spark, sf), "event_id", "text")


@register("f20_flat_entities", sql=f"WITH {_FLAT_SQL} SELECT event_id, kind, value FROM f")
def f20(spark, sf):
    """Entities of nested JSON lists, one row each."""
    return _flat(spark, sf)


@register("h1_common_entities", sql=f"WITH {_FLAT_SQL} SELECT kind, value, count(*) AS n FROM f GROUP BY ALL HAVING count(*) >= 3")
def h1(spark, sf):
    """Entities used three times or more."""
    return S.common_entities(_flat(spark, sf), 3)


_REPORT_SQL = f"""WITH {_MESSAGES_SQL}, {_FLAT_SQL},
w AS (SELECT string_split(text, ' ') AS ws FROM m), u AS (SELECT unnest(ws) AS x FROM w)
SELECT (SELECT count(DISTINCT x) / count(x) FROM u) AS word_diversity, (SELECT avg(len(ws)) FROM w) AS avg_words,
  (SELECT count(DISTINCT value) / count(value) FROM f WHERE kind = 'screen_name') AS screen_name_diversity,
  (SELECT count(DISTINCT value) / count(value) FROM f WHERE kind = 'hashtag') AS hashtag_diversity"""


@register("h2_message_report", sql=_REPORT_SQL)
def h2(spark, sf):
    """Diversity of words, names and hashtags, and words per message."""
    return S.content_report(_messages(spark, sf), _flat(spark, sf), "text")


@register("h3_favourites", sql=f"""WITH {_FLAT_SQL}, v AS (SELECT f.* FROM f JOIN events USING (event_id) WHERE event_type = 'purchase')
SELECT kind, value, count(*) AS n FROM v GROUP BY ALL HAVING count(*) >= 2""")
def h3(spark, sf):
    """Entities used twice or more in the favourites, which purchases are here."""
    e = Tables(spark, sf).events.where(F.col("event_type") == "purchase")
    fav = e.select("event_id", F.expr(MESSAGE).alias("text"), F.expr(ENTITIES).alias("entities"))
    return S.favourites_report(fav, S.flatten_entities(fav, "event_id", "entities"), "text")[0]
