"""Registered queries: document classifiers (documents x labels) and vector
classifiers (embeddings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import classify as C
from quarry.operators import kernels as KE
from quarry.operators.relational import min_max
from quarry.plans.q_relational import p11, wordset_sql
from quarry.plans.registry import register
from quarry.session import cut_lineage
from quarry.sources.tables import Tables

NB_THRESHOLDS = {"bad": 3.0}
FISHER_MINIMUMS = {"bad": 0.8, "good": 0.4}
DEFAULT = "unknown"


def _train(spark, sf, repeat=1):
    t = Tables(spark, sf)
    items = (t.documents.join(t.labels, "doc_id")
             .select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("cat"),
                     T.word_set("text").alias("fs")))
    return C.train_counts(items, "fs", "cat", repeat)


def _test_items(spark, sf):
    t = Tables(spark, sf)
    return (t.documents.join(t.labels, "doc_id", "left_anti")
            .select("doc_id", T.word_set("text").alias("fs")))


_BASE_SQL = f"""tr AS (SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS cat,
  {wordset_sql('d.text')} AS fs FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
fc AS (SELECT feature, cat, count(*) AS n FROM (SELECT cat, unnest(fs) AS feature FROM tr) GROUP BY 1, 2),
cc AS (SELECT cat, count(*) AS n FROM tr GROUP BY 1),
ccw AS (SELECT sum(n) FILTER (WHERE cat = 'bad') AS c_bad, sum(n) FILTER (WHERE cat = 'good') AS c_good, sum(n) AS total FROM cc),
ft AS (SELECT feature, coalesce(sum(n) FILTER (WHERE cat = 'bad'), 0) AS n_bad,
              coalesce(sum(n) FILTER (WHERE cat = 'good'), 0) AS n_good FROM fc GROUP BY 1),
ft2 AS (SELECT ft.*, n_bad + n_good AS totals, n_bad / c_bad AS fp_bad, n_good / c_good AS fp_good FROM ft, ccw),
ft3 AS (SELECT *, (0.5 + totals * fp_bad) / (1 + totals) AS wnb_bad, (0.5 + totals * fp_good) / (1 + totals) AS wnb_good,
   CASE WHEN fp_bad = 0 THEN 0.0 ELSE fp_bad / (fp_bad + fp_good) END AS cp_bad,
   CASE WHEN fp_good = 0 THEN 0.0 ELSE fp_good / (fp_bad + fp_good) END AS cp_good FROM ft2),
ft4 AS (SELECT *, (0.5 + totals * cp_bad) / (1 + totals) AS wfi_bad, (0.5 + totals * cp_good) / (1 + totals) AS wfi_good FROM ft3),
te AS (SELECT doc_id, {wordset_sql('text')} AS fs FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
tf AS (SELECT doc_id, unnest(fs) AS feature FROM te),
agg AS (SELECT doc_id, sum(ln(coalesce(wnb_bad, 0.5))) AS nb_bad, sum(ln(coalesce(wnb_good, 0.5))) AS nb_good,
   sum(ln(coalesce(wfi_bad, 0.5))) AS fi_bad, sum(ln(coalesce(wfi_good, 0.5))) AS fi_good, count(*) AS nf
   FROM tf LEFT JOIN ft4 USING (feature) GROUP BY 1),
sc AS (SELECT te.doc_id, coalesce(nb_bad, 0.0) AS nb_bad, coalesce(nb_good, 0.0) AS nb_good,
   coalesce(fi_bad, 0.0) AS fi_bad, coalesce(fi_good, 0.0) AS fi_good, coalesce(nf, 0) AS nf FROM te LEFT JOIN agg USING (doc_id)),
nb AS (SELECT doc_id, 'bad' AS cat, nb_bad + ln(c_bad / total) AS logprob FROM sc, ccw
       UNION ALL SELECT doc_id, 'good', nb_good + ln(c_good / total) FROM sc, ccw),
fi AS (SELECT doc_id, 'bad' AS cat, -fi_bad AS m, nf FROM sc UNION ALL SELECT doc_id, 'good', -fi_good, nf FROM sc),
lf AS (SELECT i, sum(CASE WHEN i = 0 THEN 0.0 ELSE ln(i) END) OVER (ORDER BY i) AS lfact
       FROM range(0, (SELECT max(nf) FROM fi) + 1) t(i)),
terms AS (SELECT doc_id, cat, -m + i * ln(m) - lfact AS lt FROM fi JOIN lf ON lf.i < greatest(fi.nf, 1) WHERE m > 0),
lse AS (SELECT doc_id, cat, mx + ln(sum(exp(lt - mx))) AS s FROM (
   SELECT *, max(lt) OVER (PARTITION BY doc_id, cat) AS mx FROM terms) GROUP BY doc_id, cat, mx),
fisher AS (SELECT fi.doc_id, fi.cat, CASE WHEN m <= 0 THEN 1.0 ELSE least(exp(s), 1.0) END AS prob
   FROM fi LEFT JOIN lse USING (doc_id, cat))"""


@register("a17_feature_counts", sql=f"WITH {_BASE_SQL} SELECT feature, cat, n FROM fc")
def a17(spark, sf):
    """Labelled documents per (word, category)."""
    return _train(spark, sf)[0]


@register("b1_category_counts", sql=f"WITH {_BASE_SQL} SELECT cat, n FROM cc")
def b1(spark, sf):
    """Labelled documents per category."""
    return _train(spark, sf)[1]


@register("b2_b3_feature_probabilities", sql=f"""WITH {_BASE_SQL}
SELECT feature, fp_bad AS fprob_c_bad, fp_good AS fprob_c_good, wnb_bad AS wnb_c_bad, wnb_good AS wnb_c_good FROM ft4""")
def b2(spark, sf):
    """fprob and weighted probability of every word in both categories."""
    fc, cc = _train(spark, sf)
    cats = C.category_list(cc)
    return C.feature_table(fc, cats).select("feature", *[F.col(f"{m}_{i}").alias(f"{m}_c_{c}")
                                                         for m in ("fprob", "wnb") for i, (c, _) in enumerate(cats)])


@register("b6_category_probabilities", sql=f"""WITH {_BASE_SQL}
SELECT feature, cp_bad AS cprob_c_bad, cp_good AS cprob_c_good, wfi_bad AS wfi_c_bad, wfi_good AS wfi_c_good FROM ft4""")
def b6(spark, sf):
    """cprob and its weighted form of every word in both categories."""
    fc, cc = _train(spark, sf)
    cats = C.category_list(cc)
    return C.feature_table(fc, cats).select("feature", *[F.col(f"{m}_{i}").alias(f"{m}_c_{c}")
                                                         for m in ("cprob", "wfi") for i, (c, _) in enumerate(cats)])


@register("b4_naive_bayes_scores", sql=f"WITH {_BASE_SQL} SELECT doc_id, cat, logprob FROM nb")
def b4(spark, sf):
    """ln P(category | words) up to a constant, for every unlabelled document."""
    fc, cc = _train(spark, sf)
    return C.nb_scores(_test_items(spark, sf), "doc_id", "fs", fc, cc)


@register("b5_naive_bayes_classify", sql=f"""WITH {_BASE_SQL},
top AS (SELECT doc_id, max(logprob) AS mx FROM nb GROUP BY 1),
best AS (SELECT nb.doc_id, min(cat) AS best, any_value(mx) AS mx FROM nb JOIN top USING (doc_id) WHERE logprob = mx GROUP BY 1),
beaten AS (SELECT DISTINCT nb.doc_id FROM nb JOIN best USING (doc_id)
           WHERE cat <> best AND logprob + CASE WHEN best = 'bad' THEN ln(3.0) ELSE 0.0 END > mx)
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM beaten) THEN '{DEFAULT}' ELSE best END AS category FROM best""")
def b5(spark, sf):
    """Naive Bayes decision with threshold 3 on 'bad'."""
    fc, cc = _train(spark, sf)
    return C.nb_classify(_test_items(spark, sf), "doc_id", "fs", fc, cc, NB_THRESHOLDS, DEFAULT)


@register("b7_fisher_scores", sql=f"WITH {_BASE_SQL} SELECT doc_id, cat, prob FROM fisher")
def b7(spark, sf):
    """Fisher probability of each category for every unlabelled document."""
    fc, cc = _train(spark, sf)
    return C.fisher_scores(_test_items(spark, sf), "doc_id", "fs", fc, cc)


@register("b8_fisher_classify", sql=f"""WITH {_BASE_SQL},
ok AS (SELECT * FROM fisher WHERE prob > CASE cat WHEN 'bad' THEN 0.8 WHEN 'good' THEN 0.4 ELSE 0.0 END AND prob > 0),
mx AS (SELECT doc_id, max(prob) AS mx FROM ok GROUP BY 1),
pick AS (SELECT ok.doc_id, min(cat) AS category FROM ok JOIN mx USING (doc_id) WHERE prob = mx GROUP BY 1)
SELECT d.doc_id, coalesce(category, '{DEFAULT}') AS category FROM (SELECT DISTINCT doc_id FROM fisher) d LEFT JOIN pick USING (doc_id)""")
def b8(spark, sf):
    """Fisher decision with minimums 0.8 (bad) and 0.4 (good)."""
    fc, cc = _train(spark, sf)
    return C.fisher_classify(_test_items(spark, sf), "doc_id", "fs", fc, cc, FISHER_MINIMUMS, DEFAULT)


@register("b9_repeat_training", sql=f"WITH {_BASE_SQL} SELECT feature, cat, n * 10 AS n FROM fc")
def b9(spark, sf):
    """Feature counts after training the labelled set ten times."""
    return _train(spark, sf, repeat=10)[0]


_MATRIX_SQL = """mt AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: length(x) >= 4)) AS word FROM documents),
mc AS (SELECT doc_id, word, count(*) AS n FROM mt GROUP BY 1, 2),
mk AS (SELECT word FROM mc GROUP BY 1 HAVING sum(n) > 3 AND sum(n) < (SELECT count(*) FROM documents) * 0.6),
cells AS (SELECT doc_id, word FROM mc SEMI JOIN mk USING (word)),
names AS (SELECT d.doc_id, coalesce(list(word) FILTER (word IS NOT NULL), []) AS fs FROM documents d LEFT JOIN cells USING (doc_id) GROUP BY 1)"""


def _names(spark, sf):
    """per document the names of its non-zero matrix columns."""
    cells = p11(spark, sf).where("n > 0").groupBy("doc_id").agg(F.collect_list("word").alias("fs"))
    docs = Tables(spark, sf).documents.select("doc_id")
    return docs.join(cells, "doc_id", "left").select("doc_id", F.coalesce("fs", F.array().cast("array<string>")).alias("fs"))


@register("f41_feature_names", sql=f"WITH {_MATRIX_SQL} SELECT doc_id, array_to_string(list_sort(fs), ' ') AS names FROM names")
def f41(spark, sf):
    """Names of the non-zero columns of the document x word matrix."""
    return _names(spark, sf).select("doc_id", F.array_join(F.array_sort("fs"), " ").alias("names"))


_VECTORS_SQL = (f"{_MATRIX_SQL},\n" + _BASE_SQL
                .replace(f"{wordset_sql('d.text')} AS fs FROM documents d JOIN labels l ON d.doc_id = l.doc_id", "d.fs FROM names d JOIN labels l ON d.doc_id = l.doc_id")
                .replace(f"{wordset_sql('text')} AS fs FROM documents WHERE", "fs FROM names WHERE"))


@register("b10_classify_word_vectors", sql=f"""WITH {_VECTORS_SQL}
SELECT doc_id, CASE WHEN nb_bad + ln(c_bad / total) >= nb_good + ln(c_good / total) THEN 'bad' ELSE 'good' END AS category FROM sc, ccw""")
def b10(spark, sf):
    """Naive Bayes over the word vectors of the matrix."""
    labels = Tables(spark, sf).labels
    names = cut_lineage(_names(spark, sf))
    train = names.join(labels, "doc_id").select(F.when(F.col("quality") == 1, "good").otherwise("bad").alias("cat"), "fs")
    fc, cc = C.train_counts(train, "fs", "cat")
    return C.nb_classify(names.join(labels, "doc_id", "left_anti"), "doc_id", "fs", fc, cc)


# ---- vector classifiers ----------------------------------------------------------

_MEANS_SQL = """vl AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m FROM vl WHERE label IN (0, 1) GROUP BY 1, 2),
m0 AS (SELECT pos, m FROM means WHERE label = 0), m1 AS (SELECT pos, m FROM means WHERE label = 1)"""


def _two_class(t):
    return t.embeddings.where(F.col("label").isin(0, 1))


@register("b11_nearest_mean_classify", sql=f"""WITH {_MEANS_SQL},
b AS (SELECT ((SELECT sum(m*m) FROM m1) - (SELECT sum(m*m) FROM m0)) / 2 AS b),
y AS (SELECT vl.vec_id, sum(vl.x * m0.m) - sum(vl.x * m1.m) AS y FROM vl JOIN m0 USING (pos) JOIN m1 USING (pos) GROUP BY 1)
SELECT vec_id, CASE WHEN y + (SELECT b FROM b) > 0 THEN 0 ELSE 1 END AS predicted FROM y""")
def b11(spark, sf):
    """Every vector classified by the nearer of the class 0 / class 1 means."""
    t = Tables(spark, sf)
    means = C.class_means(_two_class(t), "embedding", "label")
    return t.embeddings.select("vec_id", C.nearest_mean_classify(t.embeddings, "embedding", means).alias("predicted"))


@register("b12_kernel_classify", sql="""WITH vl AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
  unnest(range(0, len(embedding))) AS pos FROM embeddings),
q AS (SELECT label AS query_id, pos, avg(x) AS qx FROM vl GROUP BY 1, 2),
d AS (SELECT q.query_id, vl.vec_id, any_value(vl.label) AS label, sum((vl.x - q.qx) * (vl.x - q.qx)) AS sq
      FROM q JOIN vl USING (pos) WHERE vl.label IN (0, 1) GROUP BY 1, 2),
k AS (SELECT query_id, sum(exp(-10.0 * sq)) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 0)
          - sum(exp(-10.0 * sq)) FILTER (WHERE label = 1) / count(*) FILTER (WHERE label = 1) AS y FROM d GROUP BY 1)
SELECT query_id, y, CASE WHEN y > 0 THEN 0 ELSE 1 END AS predicted FROM k""")
def b12(spark, sf):
    """RBF-kernel decision for the mean vector of every label (offset 0)."""
    t = Tables(spark, sf)
    qs = sorted(C.class_means(t.embeddings, "embedding", "label").items())
    return C.kernel_classify(_two_class(t), "embedding", "label", qs)


@register("b14_min_max_scale", sql="""WITH vl AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
r AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM vl GROUP BY 1)
SELECT vec_id, list(CASE WHEN hi = lo THEN 0.0 ELSE (x - lo) / (hi - lo) END ORDER BY pos) AS scaled
FROM vl JOIN r USING (pos) GROUP BY 1""")
def b14(spark, sf):
    """Every vector scaled to [0, 1] per dimension."""
    e = Tables(spark, sf).embeddings
    rng = sorted(min_max(e, "embedding").collect(), key=lambda r: r["pos"])
    lows, highs = [r["low"] for r in rng], [r["high"] for r in rng]
    return e.select("vec_id", C.min_max_scale(e, "embedding", lows, highs).alias("scaled"))


def _kernel_rows(spark, sf):
    return Tables(spark, sf).embeddings.select("vec_id", F.col("embedding").alias("vec"), "label")


@register("b12_kernel_rows", sql="""WITH vl AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
  unnest(range(0, len(embedding))) AS pos FROM embeddings),
d AS (SELECT q.vec_id AS query_id, vl.vec_id, any_value(vl.label) AS label, sum((vl.x - q.x) * (vl.x - q.x)) AS sq
      FROM vl JOIN vl q ON q.pos = vl.pos AND q.vec_id % 100 = 0 WHERE vl.label IN (0, 1) GROUP BY 1, 2),
k AS (SELECT query_id, sum(exp(-10.0 * sq)) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 0)
          - sum(exp(-10.0 * sq)) FILTER (WHERE label = 1) / count(*) FILTER (WHERE label = 1) AS y FROM d GROUP BY 1)
SELECT query_id, y, CASE WHEN y > 0 THEN 0 ELSE 1 END AS predicted FROM k""")
def b12_rows(spark, sf):
    """RBF-kernel decision of every row with vec_id % 100 = 0 against all rows."""
    rows = _kernel_rows(spark, sf)
    return KE.kernel_decisions(rows, rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "vec"))


@register("b13_kernel_offset")
def b13(spark, sf):
    """Mean kernel within class 1 less that within class 0, by random features."""
    rows = _kernel_rows(spark, sf)
    return rows.agg(F.lit(KE.kernel_offset(rows)).alias("kernel_offset"))


@register("b16_rbf_classifier")
def b16(spark, sf):
    """Every row with vec_id % 100 = 0 classified as label 0 or 1 by a kernel
    machine trained on the other rows of these labels."""
    rows = _kernel_rows(spark, sf)
    model = KE.train_rbf(rows.where("vec_id % 100 <> 0"))
    return model.predict(rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "vec")).select("query_id", "predicted")
