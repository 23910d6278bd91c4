"""Registered queries: search index, links, PageRank and ranking scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import search as S
from quarry.plans.registry import register
from quarry.session import cut_lineage
from quarry.sources.tables import PART_EDGES_SQL, Tables

DOC_QUERY = "de la que"
PAGE_QUERY = "de la"
ANCHOR_QUERY = ["thanedble", "attion"]
IGNORE_SQL = "(" + ", ".join(f"'{w}'" for w in T.INDEX_STOP_WORDS) + ")"

_WORDS_SQL = "list_filter(regexp_split_to_array(lower({c}), '[^a-zA-Z0-9_]+'), lambda x: x <> '')"
_VISIBLE_SQL = ("regexp_replace(regexp_replace(regexp_replace({c}, '(?s)<!--(.*?)-->', E'\\n\\\\1\\n', 'g'), "
                "'<!([^>]*)>', E'\\n\\\\1\\n', 'g'), '<[^>]*>', E'\\n', 'g')")


def _index_sql(table: str, key: str, text_expr: str) -> str:
    return f"""ws AS (SELECT {key} AS urlid, {_WORDS_SQL.format(c=text_expr)} AS t FROM {table}),
wl AS (SELECT * FROM (SELECT urlid, unnest(t) AS word, unnest(range(0, len(t))) AS location FROM ws)
       WHERE word NOT IN {IGNORE_SQL})"""


DOC_INDEX_SQL = _index_sql("documents", "doc_id", "text")
PAGE_INDEX_SQL = _index_sql("pages", "url", _VISIBLE_SQL.format(c="html"))


def _summary_sql(words: list[str]) -> str:
    """Match summary in SQL; the distance DP unrolled over the query words."""
    k = len(words)
    q = ", ".join(f"('{w}', {i})" for i, w in enumerate(words))
    parts = [f"""q(word, qi) AS (VALUES {q}),
qp0 AS (SELECT urlid, qi, location FROM wl JOIN q USING (word)),
qp AS (SELECT * FROM qp0 WHERE urlid IN (SELECT urlid FROM qp0 GROUP BY urlid HAVING count(DISTINCT qi) = {k})),
per AS (SELECT urlid, qi, count(*) AS c, min(location) AS m FROM qp GROUP BY 1, 2),
s AS (SELECT urlid, sum(ln(c)) AS log_rows, sum(m)::BIGINT AS loc_sum FROM per GROUP BY 1),
dp0 AS (SELECT urlid, location AS pos, 0::BIGINT AS dp FROM qp WHERE qi = 0)"""]
    for i in range(1, k):
        parts.append(f"""u{i} AS (SELECT urlid, pos, dp, 0 AS kind FROM dp{i-1}
  UNION ALL SELECT urlid, location, NULL, 1 FROM qp WHERE qi = {i}),
dp{i} AS (SELECT urlid, pos, least(l, r) AS dp FROM (SELECT *,
  min(CASE WHEN kind = 0 THEN dp - pos END) OVER (PARTITION BY urlid ORDER BY pos RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + pos AS l,
  min(CASE WHEN kind = 0 THEN dp + pos END) OVER (PARTITION BY urlid ORDER BY pos RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - pos AS r
  FROM u{i}) WHERE kind = 1)""")
    parts.append(f"""md AS (SELECT urlid, min(dp) AS min_dist FROM dp{k-1} GROUP BY 1),
summary AS (SELECT s.urlid, log_rows, loc_sum, md.min_dist FROM s JOIN md USING (urlid)),
freq AS (SELECT urlid, exp(log_rows - (SELECT max(log_rows) FROM summary)) AS score FROM summary),
loc AS (SELECT urlid, (SELECT min(loc_sum) FROM summary) / greatest(0.00001, loc_sum) AS score FROM summary),
dist AS (SELECT urlid, (SELECT min(min_dist) FROM summary) / greatest(0.00001, min_dist) AS score FROM summary)""")
    return ",\n".join(parts)


def _doc_index(spark, sf, only=None):
    d = Tables(spark, sf).documents
    return S.word_locations(d, "doc_id", F.col("text"), only)


def _page_index(spark, sf, only=None):
    p = Tables(spark, sf).pages
    return S.word_locations(p, "url", T.visible_text(F.col("html")), only)


@register("rk1_index_documents", sql=f"WITH {DOC_INDEX_SQL} SELECT urlid, word, location FROM wl")
def rk1d(spark, sf):
    """Word locations of every document, ignored words skipped."""
    return _doc_index(spark, sf)


@register("rk1_index_pages", sql=f"WITH {PAGE_INDEX_SQL} SELECT urlid, word, location FROM wl")
def rk1p(spark, sf):
    """Word locations of the visible text of every page."""
    return _page_index(spark, sf)


# The links of the given pages are rooted, absolute or empty; the oracle cuts the
# page URL with string functions, not with the operator's patterns.
_HREF = S.ANCHOR.replace("'", "''")
_LINKS_SQL = f"""a AS (SELECT url AS fromid, regexp_extract_all(html, '{_HREF}', 1) AS h1, regexp_extract_all(html, '{_HREF}', 2) AS h2,
    regexp_extract_all(html, '{_HREF}', 3) AS h3, regexp_extract_all(html, '{_HREF}', 4) AS t FROM pages),
b AS (SELECT fromid, coalesce(unnest(h1), '') || coalesce(unnest(h2), '') || coalesce(unnest(h3), '') AS h, unnest(t) AS anchor, unnest(range(0, len(t))) AS seq FROM a),
p AS (SELECT *, split_part(fromid, '://', 1) AS scheme,
             split_part(split_part(split_part(split_part(fromid, '://', 2), '/', 1), '?', 1), '#', 1) AS host FROM b),
r AS (SELECT fromid, seq, anchor, split_part(CASE
    WHEN h = '' THEN fromid
    WHEN contains(h, '://') THEN h
    WHEN starts_with(h, '//') THEN scheme || ':' || h
    WHEN starts_with(h, '/') THEN scheme || '://' || host || h
    ELSE 'not covered' END, '#', 1) AS toid FROM p),
link AS (SELECT fromid || '#' || seq AS linkid, fromid, toid, anchor FROM r
         WHERE NOT contains(toid, '''') AND toid <> fromid)"""


@register("rk2_links", sql=f"WITH {_LINKS_SQL} SELECT linkid, fromid, toid FROM link")
def rk2(spark, sf):
    """Links of the stored pages, resolved against the page URL."""
    return S.page_links(Tables(spark, sf).pages)[0]


@register("rk2_link_words", sql=f"""WITH {_LINKS_SQL},
lw AS (SELECT linkid, unnest({_WORDS_SQL.format(c=_VISIBLE_SQL.format(c='anchor'))}) AS word FROM link)
SELECT linkid, word FROM lw WHERE word NOT IN {IGNORE_SQL}""")
def rk2w(spark, sf):
    """Words of every link's anchor text."""
    return S.page_links(Tables(spark, sf).pages)[1]


def _pagerank_sql(edges_cte: str, rounds: int = 20) -> str:
    parts = [edges_cte,
             """outdeg AS (SELECT fromid AS src, count(*) AS c FROM link GROUP BY 1),
w AS (SELECT d.src, d.dst, 1.0 / c AS w FROM (SELECT DISTINCT fromid AS src, toid AS dst FROM link) d JOIN outdeg USING (src)),
pr0 AS (SELECT id, 1.0 AS score FROM nodes)"""]
    for i in range(1, rounds + 1):
        parts.append(f"""pr{i} AS (SELECT n.id, 0.15 + 0.85 * coalesce(x.s, 0.0) AS score FROM nodes n LEFT JOIN
  (SELECT w.dst, sum(p.score * w.w) AS s FROM w JOIN pr{i-1} p ON p.id = w.src GROUP BY w.dst) x ON x.dst = n.id)""")
    return "WITH " + ",\n".join(parts)


_PART_LINK_CTE = f"""{PART_EDGES_SQL},
link AS (SELECT src AS fromid, dst AS toid FROM part_edges WHERE src <> dst),
nodes AS (SELECT src AS id FROM part_edges UNION SELECT dst FROM part_edges)"""


@register("rk3_pagerank", sql=_pagerank_sql(_PART_LINK_CTE) + "\nSELECT id AS urlid, score FROM pr20")
def rk3(spark, sf):
    """20 PageRank rounds on the part graph."""
    e = Tables(spark, sf).part_edges()
    link = e.where(F.col("src") != F.col("dst")).select(F.col("src").alias("fromid"), F.col("dst").alias("toid"))
    urls = e.select(F.col("src").alias("urlid")).union(e.select("dst")).distinct()
    return S.pagerank(link, urls, 20)


_DOC_SUMMARY = f"WITH {DOC_INDEX_SQL},\n{_summary_sql(S.query_words(DOC_QUERY))}"


def _doc_summary(spark, sf):
    words = S.query_words(DOC_QUERY)
    return S.match_summary(_doc_index(spark, sf, words), words)


@register("rk4_match_summary", sql=_DOC_SUMMARY + "\nSELECT * FROM summary")
def rk4(spark, sf):
    """Per matching document: match-row count, best position sum, best distance."""
    return _doc_summary(spark, sf)


@register("rk6_frequency_score", sql=_DOC_SUMMARY + "\nSELECT * FROM freq")
def rk6(spark, sf):
    return S.frequency_score(_doc_summary(spark, sf))


@register("rk7_location_score", sql=_DOC_SUMMARY + "\nSELECT * FROM loc")
def rk7(spark, sf):
    return S.location_score(_doc_summary(spark, sf))


@register("rk8_distance_score", sql=_DOC_SUMMARY + "\nSELECT * FROM dist")
def rk8(spark, sf):
    return S.distance_score(_doc_summary(spark, sf), len(S.query_words(DOC_QUERY)))


@register("rk12_search_documents", sql=_DOC_SUMMARY + """,
total AS (SELECT urlid, sum(s) AS score FROM (SELECT urlid, score AS s FROM loc UNION ALL SELECT urlid, score FROM freq
  UNION ALL SELECT urlid, score FROM dist) GROUP BY urlid)
SELECT urlid, score FROM total ORDER BY score DESC, urlid DESC LIMIT 10""")
def rk12d(spark, sf):
    """Top 10 documents for the query by location + frequency + distance."""
    s = _doc_summary(spark, sf)
    k = len(S.query_words(DOC_QUERY))
    return S.weighted_total([(1.0, S.location_score(s)), (1.0, S.frequency_score(s)), (1.0, S.distance_score(s, k))])


_PAGE_LINK_CTE = f"""{_LINKS_SQL},
nodes AS (SELECT fromid AS id FROM link UNION SELECT toid FROM link UNION SELECT url FROM pages)"""


def _page_graph(spark, sf):
    p = Tables(spark, sf).pages
    link, lw = S.page_links(p)
    link = cut_lineage(link)   # read up to five times; every reading would search the pages' html again
    urls = S.url_list(link, p.select(F.col("url").alias("urlid")))
    return link, lw, urls


@register("rk9_inbound_link_score", sql=f"""WITH {_PAGE_LINK_CTE},
c AS (SELECT n.id AS urlid, count(l.toid) AS n FROM nodes n LEFT JOIN link l ON l.toid = n.id GROUP BY 1)
SELECT urlid, n / (SELECT CASE WHEN max(n) = 0 THEN 0.00001 ELSE max(n) END FROM c) AS score FROM c""")
def rk9(spark, sf):
    """Inbound links of every known url, max-normalised."""
    link, _, urls = _page_graph(spark, sf)
    return S.inbound_link_score(urls, link)


@register("rk10_linktext_score", sql=_pagerank_sql(_PAGE_LINK_CTE) + f""",
lw AS (SELECT DISTINCT linkid, word FROM (SELECT linkid, unnest({_WORDS_SQL.format(c=_VISIBLE_SQL.format(c='anchor'))}) AS word FROM link)
       WHERE word IN ({", ".join(f"'{w}'" for w in ANCHOR_QUERY)})),
hits AS (SELECT l.toid, pr20.score FROM lw JOIN link l USING (linkid) JOIN pr20 ON pr20.id = l.fromid),
s AS (SELECT n.id AS urlid, coalesce(sum(h.score), 0.0) AS s FROM nodes n LEFT JOIN hits h ON h.toid = n.id GROUP BY 1)
SELECT urlid, s / nullif((SELECT max(s) FROM s), 0) AS score FROM s""")
def rk10(spark, sf):
    """Link-text score of every known url for two anchor words."""
    link, lw, urls = _page_graph(spark, sf)
    pr = S.pagerank(link, urls, 20)
    return S.linktext_score(urls, link, lw, pr, ANCHOR_QUERY)


@register("rk11_pagerank_score", sql=_pagerank_sql(_PAGE_LINK_CTE) +
          "\nSELECT id AS urlid, score / (SELECT max(score) FROM pr20) AS score FROM pr20")
def rk11(spark, sf):
    """PageRank of every known url over the page link graph, max-normalised."""
    link, _, urls = _page_graph(spark, sf)
    return S.pagerank_score(urls, S.pagerank(link, urls, 20))


_PAGE_SUMMARY = f"WITH {PAGE_INDEX_SQL},\n{_summary_sql(S.query_words(PAGE_QUERY))}"


@register("rk12_search_pages", sql=_PAGE_SUMMARY + """,
total AS (SELECT urlid, sum(s) AS score FROM (SELECT urlid, score AS s FROM loc UNION ALL SELECT urlid, score FROM freq
  UNION ALL SELECT urlid, score FROM dist) GROUP BY urlid)
SELECT urlid, score FROM total ORDER BY score DESC, urlid DESC LIMIT 10""")
def rk12p(spark, sf):
    """Top 10 pages for the query by location + frequency + distance."""
    words = S.query_words(PAGE_QUERY)
    s = S.match_summary(_page_index(spark, sf, words), words)
    k = len(words)
    return S.weighted_total([(1.0, S.location_score(s)), (1.0, S.frequency_score(s)), (1.0, S.distance_score(s, k))])


RARE_QUERY = ["chouou", "que"]


@register("j1_match_rows", sql=f"""WITH {DOC_INDEX_SQL}
SELECT a.urlid, a.location AS loc0, b.location AS loc1 FROM wl a JOIN wl b USING (urlid) WHERE a.word = '{RARE_QUERY[0]}' AND b.word = '{RARE_QUERY[1]}'""")
def j1(spark, sf):
    """Every combination of places of two words, one of them rare."""
    return S.match_rows(_doc_index(spark, sf, RARE_QUERY), RARE_QUERY)


# Queries are part names, their words the query words; candidates are the
# brands of the parts of that name, clicked is the brand sold most often.
_CLICKS_SQL = """words AS (SELECT DISTINCT p_name AS query_id, unnest(string_split(p_name, ' ')) AS word FROM part),
urls AS (SELECT DISTINCT p_name AS query_id, p_brand AS urlid FROM part),
sold AS (SELECT p_name AS query_id, p_brand AS urlid, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
clicks AS (SELECT query_id, urlid FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, urlid) AS r FROM sold) WHERE r = 1),
keys AS (SELECT query_id, list_sort(list(word)) AS ws FROM words GROUP BY 1),
keyed AS (SELECT query_id, ws, array_to_string(ws, '_') AS hid FROM keys WHERE len(ws) <= 3),
wh AS (SELECT DISTINCT unnest(ws) AS word, hid, 1.0 / len(ws) AS s FROM keyed),
hu AS (SELECT DISTINCT hid, urlid, 0.1 AS s FROM keyed JOIN urls USING (query_id)),
hids AS (SELECT query_id, hid FROM words JOIN wh USING (word) UNION SELECT query_id, hid FROM urls JOIN hu USING (urlid)),
ah AS (SELECT h.query_id, h.hid, tanh(sum(coalesce(wh.s, -0.2))) AS ah FROM hids h JOIN words w ON w.query_id = h.query_id
       LEFT JOIN wh ON wh.word = w.word AND wh.hid = h.hid GROUP BY ALL),
ao AS (SELECT u.query_id, u.urlid, tanh(coalesce(sum(ah.ah * hu.s), 0.0)) AS ao FROM urls u LEFT JOIN ah ON ah.query_id = u.query_id
       LEFT JOIN hu ON hu.hid = ah.hid AND hu.urlid = u.urlid GROUP BY ALL)"""


def _clicks(spark, sf):
    t = Tables(spark, sf)
    words = t.part.select(F.col("p_name").alias("query_id"), F.explode(F.split("p_name", " ")).alias("word")).distinct()
    urls = t.part.select(F.col("p_name").alias("query_id"), F.col("p_brand").alias("urlid")).distinct()
    sold = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_name").alias("query_id"), F.col("p_brand").alias("urlid"))
            .agg(F.count(F.lit(1)).alias("n")))
    best = sold.groupBy("query_id").agg(F.min_by("urlid", F.struct(-F.col("n"), "urlid")).alias("urlid"))
    return words, urls, best


@register("rk14_click_scores", sql=f"WITH {_CLICKS_SQL} SELECT query_id, urlid, ao AS score FROM ao")
def rk14(spark, sf):
    """Output of the untrained click network for every query and candidate."""
    words, urls, _ = _clicks(spark, sf)
    wh, hu = S.click_network(words, urls)
    return S.nn_scores(wh, hu, words, urls)


@register("rk13_click_training", sql=f"""WITH {_CLICKS_SQL},
od AS (SELECT ao.query_id, ao.urlid, (1 - ao * ao) * (CASE WHEN c.urlid IS NULL THEN 0.0 ELSE 1.0 END - ao) AS od
       FROM ao LEFT JOIN clicks c ON c.query_id = ao.query_id AND c.urlid = ao.urlid),
hd AS (SELECT ah.query_id, ah.hid, any_value((1 - ah * ah)) * sum(od.od * coalesce(hu.s, 0.0)) AS hd FROM ah JOIN od USING (query_id)
       LEFT JOIN hu ON hu.hid = ah.hid AND hu.urlid = od.urlid GROUP BY ALL),
nhu AS (SELECT ah.hid, od.urlid, coalesce(any_value(hu.s), 0.0) + 0.5 * sum(od.od * ah.ah) AS s FROM ah JOIN od USING (query_id)
        LEFT JOIN hu ON hu.hid = ah.hid AND hu.urlid = od.urlid GROUP BY ALL),
nwh AS (SELECT w.word, hd.hid, coalesce(any_value(wh.s), -0.2) + 0.5 * sum(hd.hd) AS s FROM words w JOIN hd USING (query_id)
        LEFT JOIN wh ON wh.word = w.word AND wh.hid = hd.hid GROUP BY ALL)
SELECT 'word' AS layer, word AS fromid, hid AS toid, s AS strength FROM nwh
UNION ALL SELECT 'url', hid, urlid, s FROM nhu""")
def rk13(spark, sf):
    """The network's edges after one batch of clicks."""
    words, urls, clicks = _clicks(spark, sf)
    wh, hu = S.train_clicks(*S.click_network(words, urls), words, urls, clicks)
    layer = lambda df, name: df.select(F.lit(name).alias("layer"), "fromid", "toid", "strength")
    return layer(wh, "word").unionByName(layer(hu, "url"))
