"""Registered queries: text mining over the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import text_mining as X
from quarry.plans.registry import register
from quarry.sources.tables import Tables

QUERY = ["que", "und", "the"]

WS_SQL = r"list_filter(regexp_split_to_array(lower({c}), '\s+'), lambda x: x <> '')"
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in T.ENGLISH_STOP_WORDS) + ")"
_TERMS_SQL = f"""ws AS (SELECT doc_id, {WS_SQL.format(c='text')} AS t FROM documents),
terms AS (SELECT doc_id, term, len, count(*) AS n FROM (
  SELECT doc_id, len(t) AS len, unnest(t) AS term FROM ws) GROUP BY ALL)"""


def _docs(spark, sf):
    return Tables(spark, sf).documents.select("doc_id", "text")


@register("x1_tf", sql=f"WITH {_TERMS_SQL} SELECT doc_id, term, n / len AS tf FROM terms")
def x1(spark, sf):
    """Term frequency of every term in every document."""
    return X.tf(X.ws_terms(_docs(spark, sf))).select("doc_id", "term", "tf")


@register("x2_idf", sql=f"""WITH {_TERMS_SQL}
SELECT term, 1.0 + ln((SELECT count(*) FROM documents) / count(DISTINCT doc_id)) AS idf FROM terms GROUP BY term""")
def x2(spark, sf):
    """1 + ln(N / df) for every term."""
    d = _docs(spark, sf)
    n = d.count()
    return X.doc_freq(X.ws_terms(d)).select("term", X.idf_one_plus(n, F.col("df")).alias("idf"))


def _query_sql(library: bool) -> str:
    idf = ("ln(ndocs / df)" if library else "1.0 + ln(ndocs / df)")
    q = ", ".join(f"('{t}')" for t in QUERY)
    body = f"""WITH {_TERMS_SQL},
q(term) AS (VALUES {q}),
hits AS (SELECT * FROM terms WHERE term IN (SELECT term FROM q)),
dfs AS (SELECT term, count(DISTINCT doc_id) AS df, (SELECT count(*) FROM documents) AS ndocs FROM hits GROUP BY term),
scored AS (SELECT doc_id, sum(n / len * ({idf})) AS score FROM hits JOIN dfs USING (term) GROUP BY doc_id)"""
    if library:
        return body + " SELECT doc_id, score FROM scored WHERE score > 0"
    return body + " SELECT d.doc_id, coalesce(score, 0.0) AS score FROM documents d LEFT JOIN scored s ON d.doc_id = s.doc_id"


@register("x3_tfidf_query", sql=_query_sql(False))
def x3(spark, sf):
    """Summed TF-IDF of the query terms for every document."""
    return X.tfidf_query(_docs(spark, sf), QUERY)


@register("x4_tfidf_query_library", sql=_query_sql(True))
def x4(spark, sf):
    """Library-form TF-IDF query, positive scores only."""
    return X.tfidf_query(_docs(spark, sf), QUERY, library_form=True)


_COSINE_SQL = f"""WITH d AS (SELECT doc_id, text FROM documents WHERE length(text) > 1000),
ws AS (SELECT doc_id, {WS_SQL.format(c='text')} AS t FROM d),
terms AS (SELECT doc_id, term, len, count(*) AS n FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM ws) GROUP BY ALL),
dfs AS (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY term),
w AS (SELECT doc_id, term, n / len * ln((SELECT count(*) FROM d) / df) AS w FROM terms JOIN dfs USING (term)),
w2 AS (SELECT * FROM w WHERE w <> 0),
norms AS (SELECT doc_id, sqrt(sum(w*w)) AS norm FROM w2 GROUP BY 1),
dots AS (SELECT a.doc_id AS d1, b.doc_id AS d2, sum(a.w * b.w) AS dot FROM w2 a JOIN w2 b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY 1, 2),
dist AS (SELECT d1, d2, round(1.0 - dot / (n1.norm * n2.norm), 9) AS dist FROM dots
         JOIN norms n1 ON n1.doc_id = d1 JOIN norms n2 ON n2.doc_id = d2),
best AS (SELECT d1, d2, dist FROM (SELECT *, row_number() OVER (PARTITION BY d1 ORDER BY dist, d2) AS r FROM dist WHERE dist < 1.0) WHERE r = 1)"""


@register("x5_most_similar", sql=f"""{_COSINE_SQL}
SELECT d.doc_id, best.d2 AS most_similar, coalesce(1.0 - best.dist, 0.0) AS score FROM d LEFT JOIN best ON d.doc_id = best.d1""")
def x5(spark, sf):
    """Nearest other long document by TF-IDF cosine distance."""
    d = _docs(spark, sf).where(F.length("text") > 1000)
    return X.most_similar(d)


@register("x5_nearest_of_queries", sql=f"""{_COSINE_SQL}
SELECT d.doc_id, best.d2 AS most_similar, coalesce(1.0 - best.dist, 0.0) AS score FROM d LEFT JOIN best ON d.doc_id = best.d1 WHERE d.doc_id % 100 = 0""")
def x5_search(spark, sf):
    """Nearest other long document of every long one with id % 100 = 0, sought
    among all long documents."""
    d = _docs(spark, sf).where(F.length("text") > 1000)
    return X.nearest_documents(d.where("doc_id % 100 = 0"), d)


TITLE = "substring(text, 1, 30)"


@register("x6_similarity_nodes", sql=f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, doc_id, {TITLE} AS title
FROM documents WHERE length(text) > 1000""")
def x6_nodes(spark, sf):
    """The long documents as numbered nodes of the similarity graph."""
    d = _docs(spark, sf).where(F.length("text") > 1000)
    return X.similarity_nodes(d, F.expr(TITLE))


@register("x6_similarity_links", sql=f"""{_COSINE_SQL}, idx AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM d)
SELECT s.i AS source, t.i AS target, coalesce(1.0 - best.dist, 0.0) AS score FROM idx s LEFT JOIN best ON s.doc_id = best.d1
LEFT JOIN idx t ON t.doc_id = best.d2 WHERE s.doc_id % 100 = 0""")
def x6_links(spark, sf):
    """Links of the similarity graph from every query document to its nearest."""
    d = _docs(spark, sf).where(F.length("text") > 1000)
    return X.similarity_graph(d.where("doc_id % 100 = 0"), d, F.expr(TITLE))[1]


def _bigram_sql():
    return f"""ws AS (SELECT doc_id, {WS_SQL.format(c='text')} AS t FROM documents),
tok AS (SELECT doc_id, unnest(t) AS w, unnest(range(0, len(t))) AS pos FROM ws),
bi AS (SELECT w1, w2, count(*) AS n FROM (
  SELECT w AS w1, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM tok) WHERE w2 IS NOT NULL GROUP BY 1, 2),
uni AS (SELECT w, count(*) AS n FROM tok GROUP BY 1)"""


@register("x7_collocations_jaccard", sql=f"""WITH {_bigram_sql()}
SELECT w1, w2, bi.n, round(bi.n / (u1.n + u2.n - bi.n), 9) AS score
FROM bi JOIN uni u1 ON u1.w = w1 JOIN uni u2 ON u2.w = w2
WHERE bi.n >= 2 AND w1 NOT IN {STOP_SQL} AND w2 NOT IN {STOP_SQL}
ORDER BY score DESC, w1, w2 LIMIT 25""")
def x7(spark, sf):
    """Best 25 bigrams by Jaccard association."""
    return X.collocations(_docs(spark, sf), 25, "jaccard")


def _llr_sql():
    cells = [("n_ii", "n_ii + n_oi", "n_ii + n_io"), ("n_oi", "n_ii + n_oi", "n_oi + n_oo"),
             ("n_io", "n_io + n_oo", "n_ii + n_io"), ("n_oo", "n_io + n_oo", "n_oi + n_oo")]
    terms = " + ".join(f"{o} * ln({o} / (({c}) * ({r}) / n_xx + 1e-20) + 1e-20)" for o, c, r in cells)
    return f"2.0 * ({terms})"


@register("x8_collocations_likelihood", sql=f"""WITH {_bigram_sql()},
base AS (SELECT w1, w2, bi.n AS n, bi.n::DOUBLE AS n_ii, (u1.n - bi.n)::DOUBLE AS n_io, (u2.n - bi.n)::DOUBLE AS n_oi,
   (SELECT count(*) FROM tok)::DOUBLE AS n_xx
   FROM bi JOIN uni u1 ON u1.w = w1 JOIN uni u2 ON u2.w = w2
   WHERE bi.n >= 2 AND w1 NOT IN {STOP_SQL} AND w2 NOT IN {STOP_SQL} AND length(w1) >= 3 AND length(w2) >= 3),
c AS (SELECT *, n_xx - n_ii - n_io - n_oi AS n_oo FROM base)
SELECT w1, w2, n, round({_llr_sql()}, 9) AS score FROM c ORDER BY score DESC, w1, w2 LIMIT 20""")
def x8(spark, sf):
    """Best 20 bigrams by log-likelihood ratio."""
    return X.collocations(_docs(spark, sf), 20, "likelihood")


@register("x9_concordance", sql=f"""WITH ws AS (SELECT doc_id, {WS_SQL.format(c='text')} AS t FROM documents),
occ AS (SELECT doc_id, t, unnest(range(0, len(t))) AS pos, unnest(t) AS w FROM ws)
SELECT doc_id, pos, array_to_string(t[greatest(pos - 5, 0) + 1 : pos], ' ') AS "left",
       array_to_string(t[pos + 2 : pos + 6], ' ') AS "right"
FROM occ WHERE w = 'que'""")
def x9(spark, sf):
    """Every 'que' with five tokens of context either side."""
    return X.concordance(_docs(spark, sf), "que", 5)


@register("x10_bigram_counts", sql=f"""WITH {_bigram_sql()} SELECT w1 || ' ' || w2 AS ngram, n FROM bi""")
def x10(spark, sf):
    """Counts of adjacent token pairs within documents."""
    return X.ngram_counts(_docs(spark, sf), 2)


_LUHN_SQL = f"""s AS (
  SELECT doc_id, unnest(ss) AS sentence, unnest(range(0, len(ss))) AS sent_idx FROM (
    SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{T.SENTENCE_PATTERN}'), lambda x: trim(x)),
                               lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) AS ss FROM documents)),
st AS (SELECT doc_id, sent_idx, regexp_extract_all(lower(sentence), '{T.TOKEN_PATTERN}') AS toks FROM s),
tk AS (SELECT doc_id, sent_idx, unnest(toks) AS w, unnest(range(0, len(toks))) AS p FROM st),
wc AS (SELECT doc_id, w, count(*) AS n FROM tk WHERE w NOT IN {STOP_SQL} GROUP BY 1, 2),
imp AS (SELECT doc_id, w FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, w ASC) AS r FROM wc) WHERE r <= 100),
fp AS (SELECT doc_id, sent_idx, w, min(p) AS p FROM tk SEMI JOIN imp USING (doc_id, w) GROUP BY ALL),
br AS (SELECT *, CASE WHEN lag(p) OVER (PARTITION BY doc_id, sent_idx ORDER BY p) IS NULL
                    OR p - lag(p) OVER (PARTITION BY doc_id, sent_idx ORDER BY p) >= 5 THEN 1 ELSE 0 END AS b FROM fp),
cl AS (SELECT *, sum(b) OVER (PARTITION BY doc_id, sent_idx ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cl FROM br),
cs AS (SELECT doc_id, sent_idx, cl, count(*) * count(*) / (max(p) - min(p) + 1) AS cs FROM cl GROUP BY ALL),
sc AS (SELECT doc_id, sent_idx, round(max(cs), 9) AS score FROM cs GROUP BY 1, 2),
o AS (SELECT *, avg(score) OVER (PARTITION BY doc_id) AS a, stddev_pop(score) OVER (PARTITION BY doc_id) AS sd,
      row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, sent_idx DESC) AS r FROM sc),
summ AS (SELECT o.doc_id, o.sent_idx, s.sentence, o.score, r <= 5 AS in_top, score > round(a + 0.5 * sd, 9) AS in_mean
         FROM o JOIN s USING (doc_id, sent_idx))"""


@register("x11_sentence_scores", sql=f"WITH {_LUHN_SQL} SELECT doc_id, sent_idx, score FROM sc")
def x11(spark, sf):
    """Luhn significance score of every sentence with an important word."""
    return X.sentence_scores(_docs(spark, sf))


@register("x12_summaries", sql=f"WITH {_LUHN_SQL} SELECT * FROM summ")
def x12(spark, sf):
    """Per scored sentence: in the top-5 summary, in the mean + 0.5 sd summary."""
    return X.summarize(_docs(spark, sf))


@register("x13_batch_summaries", sql=f"""WITH {_LUHN_SQL}
SELECT doc_id,
  coalesce(string_agg(sentence, ' ' ORDER BY sent_idx) FILTER (WHERE in_top), '') AS top_n_summary,
  coalesce(string_agg(sentence, ' ' ORDER BY sent_idx) FILTER (WHERE in_mean), '') AS mean_scored_summary
FROM summ GROUP BY doc_id""")
def x13(spark, sf):
    """Both summaries of every document as text."""
    return X.batch_summaries(_docs(spark, sf))


@register("x16_first_match", sql="""SELECT doc_id FROM documents
WHERE list_contains(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: x <> ''), 'que')
ORDER BY doc_id LIMIT 1""")
def x16(spark, sf):
    """The first document holding 'que' (limit 1 is the feature)."""
    return X.first_match(_docs(spark, sf), "que")


@register("x17_subject_search", sql="SELECT conv_id, turn FROM conversations WHERE contains(lower(text), 'chouou')")
def x17(spark, sf):
    """Conversation turns whose text contains 'chouou', ignoring case."""
    return X.subject_search(Tables(spark, sf).conversations, "text", "chouou").select("conv_id", "turn")
