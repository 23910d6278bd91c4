"""Registered queries: nearest-neighbour estimates over the embeddings table.

Rows are embeddings (input) with their label as the numeric result; the query
point is the mean vector of label 0 (derived from the data)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import knn as N
from quarry.operators import knn_join as NJ
from quarry.operators.classify import class_means
from quarry.plans.registry import register
from quarry.session import cut_lineage
from quarry.sources.tables import Tables

K = 5
HIGH = 10.0


def _data(spark, sf):
    e = Tables(spark, sf).embeddings
    data = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("input"),
                    F.col("label").cast("double").alias("result"))
    q = class_means(e.where(F.col("label") == 0), "embedding", "label")[0]
    return data, q


_DIST_SQL = """vl AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
q AS (SELECT pos, avg(x) AS qx FROM vl WHERE label = 0 GROUP BY 1),
dist AS (SELECT vl.vec_id AS id, round(sqrt(sum((vl.x - q.qx) * (vl.x - q.qx))), 9) AS distance, any_value(vl.label)::DOUBLE AS result
         FROM vl JOIN q USING (pos) GROUP BY vl.vec_id),
nn AS (SELECT * FROM dist ORDER BY distance, id LIMIT 5),
gw AS (SELECT *, exp(-(distance * distance) / (2 * 5.0 * 5.0)) AS w FROM nn)"""


@register("n1_distances", sql=f"WITH {_DIST_SQL} SELECT id, distance, result FROM dist")
def n1(spark, sf):
    """Distance of every vector to the query point."""
    data, q = _data(spark, sf)
    return N.distances(data, q)


@register("k2_n2_knn_estimate", sql=f"WITH {_DIST_SQL} SELECT avg(result) AS estimate FROM nn")
def n2(spark, sf):
    """Mean label of the 5 nearest vectors."""
    data, q = _data(spark, sf)
    return N.knn_estimate(data, q, K)


@register("n3_weighted_knn_gaussian", sql=f"""WITH {_DIST_SQL}
SELECT CASE WHEN sum(w) = 0 THEN 0.0 ELSE sum(w * result) / sum(w) END AS estimate FROM gw""")
def n3g(spark, sf):
    data, q = _data(spark, sf)
    return N.weighted_knn(data, q, K, "gaussian")


@register("n3_weighted_knn_inverse", sql=f"""WITH {_DIST_SQL},
iw AS (SELECT *, 1.0 / (distance + 0.1) AS w2 FROM nn)
SELECT CASE WHEN sum(w2) = 0 THEN 0.0 ELSE sum(w2 * result) / sum(w2) END AS estimate FROM iw""")
def n3i(spark, sf):
    data, q = _data(spark, sf)
    return N.weighted_knn(data, q, K, "inverse")


@register("n3_weighted_knn_subtract", sql=f"""WITH {_DIST_SQL},
sw AS (SELECT *, greatest(1.0 - distance, 0.0) AS w2 FROM nn)
SELECT CASE WHEN sum(w2) = 0 THEN 0.0 ELSE sum(w2 * result) / sum(w2) END AS estimate FROM sw""")
def n3s(spark, sf):
    data, q = _data(spark, sf)
    return N.weighted_knn(data, q, K, "subtract")


@register("n6_prob_guess", sql=f"""WITH {_DIST_SQL}
SELECT 2.0 AS low, 6.0 AS high, CASE WHEN sum(w) = 0 THEN 0.0
  ELSE sum(CASE WHEN result >= 2.0 AND result <= 6.0 THEN w ELSE 0.0 END) / sum(w) END AS prob FROM gw""")
def n6(spark, sf):
    """Weight share of the 5 nearest vectors with a label in [2, 6]."""
    data, q = _data(spark, sf)
    ranges = spark.createDataFrame([(2.0, 6.0)], "low double, high double")
    return N.prob_guess(data, q, ranges, K)


_GRID_SQL = f"grid AS (SELECT range AS i, range * 0.1::DOUBLE AS v FROM range(0, {int(HIGH / 0.1)}))"


@register("n7_cumulative_curve", sql=f"""WITH {_DIST_SQL}, {_GRID_SQL}
SELECT i, v, CASE WHEN (SELECT sum(w) FROM gw) = 0 THEN 0.0 ELSE
  coalesce((SELECT sum(w) FROM gw WHERE gw.result >= 0.0 AND gw.result <= grid.v), 0.0) / (SELECT sum(w) FROM gw) END AS prob
FROM grid""")
def n7(spark, sf):
    """P(label <= v) from the 5 nearest vectors, v = 0, 0.1, ... < 10."""
    data, q = _data(spark, sf)
    return N.cumulative_curve(data, q, HIGH, K)


@register("n8_smoothed_curve", sql=f"""WITH {_DIST_SQL}, {_GRID_SQL},
p AS (SELECT i AS j, CASE WHEN (SELECT sum(w) FROM gw) = 0 THEN 0.0 ELSE
  coalesce((SELECT sum(w) FROM gw WHERE gw.result >= grid.v AND gw.result <= grid.v + 0.1::DOUBLE), 0.0) / (SELECT sum(w) FROM gw) END AS prob FROM grid)
SELECT grid.i, grid.v, coalesce(sum(exp(-pow(abs(grid.i - p.j) * 0.1::DOUBLE, 2) / (2 * 5.0 * 5.0)) * p.prob), 0.0) AS smoothed
FROM grid LEFT JOIN p ON p.prob > 0 GROUP BY 1, 2""")
def n8(spark, sf):
    """Gaussian-smoothed probability of each 0.1-wide label bin."""
    data, q = _data(spark, sf)
    return N.smoothed_curve(data, q, HIGH, K)


@register("n4_random_split")
def n4(spark, sf):
    """Both parts of a seeded 10 % split (same rows in any partitioning)."""
    data, _ = _data(spark, sf)
    train, test = N.random_split(data, "id", 0.1, 42)
    return train.select("id", F.lit("train").alias("part")).unionByName(test.select("id", F.lit("test").alias("part")))


# ---- every row with vec_id % 100 = 0 as a query, against all rows -------------

TRIALS, PERCENT = 10, 10


def _rows(spark, sf):
    e = Tables(spark, sf).embeddings
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("input"), F.col("label").cast("double").alias("result"))


def _near(spark, sf):
    data = _rows(spark, sf)
    asked = data.where(F.col("id") % 100 == 0).select(F.col("id").alias("query_id"), "input")
    return NJ.nearest_join(data, asked, K)


_JOIN_SQL = f"""vl AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
dist AS (SELECT q.vec_id AS query_id, vl.vec_id AS id, any_value(vl.label)::DOUBLE AS result,
                round(sqrt(sum((vl.x - q.x) * (vl.x - q.x))), 9) AS distance
         FROM vl JOIN vl q ON q.pos = vl.pos AND q.vec_id % 100 = 0 AND q.vec_id <> vl.vec_id GROUP BY 1, 2),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM dist) WHERE rank <= {K})"""


@register("j10_k2_nearest_join", sql=f"WITH {_JOIN_SQL} SELECT query_id, id, distance, result, rank FROM nn")
def nearest_join(spark, sf):
    """The 5 nearest other vectors of every query row."""
    return _near(spark, sf).select("query_id", "id", "distance", "result", "rank")


@register("n2_knn_estimates", sql=f"WITH {_JOIN_SQL} SELECT query_id, avg(result) AS estimate FROM nn GROUP BY 1")
def n2_rows(spark, sf):
    """Mean label of the 5 nearest vectors of every query row."""
    return NJ.estimates(_near(spark, sf)).select("query_id", "estimate")


@register("n3_weighted_estimates", sql=f"""WITH {_JOIN_SQL},
w AS (SELECT *, exp(-(distance * distance) / (2 * 5.0 * 5.0)) AS g, 1.0 / (distance + 0.1) AS i, greatest(1.0 - distance, 0.0) AS s FROM nn)
SELECT query_id, sum(g * result) / sum(g) AS gaussian, sum(i * result) / sum(i) AS inverse,
       CASE WHEN sum(s) = 0 THEN 0.0 ELSE sum(s * result) / sum(s) END AS subtract FROM w GROUP BY 1""")
def n3_rows(spark, sf):
    """The weighted estimates of every query row by the three weight functions."""
    near = cut_lineage(_near(spark, sf))
    out = None
    for name in ("gaussian", "inverse", "subtract"):
        one = NJ.estimates(near, N.WEIGHTS[name](F.col("distance"))).select("query_id", F.col("estimate").alias(name))
        out = one if out is None else out.join(one, "query_id")
    return out


@register("n6_prob_guesses", sql=f"""WITH {_JOIN_SQL}, w AS (SELECT *, exp(-(distance * distance) / (2 * 5.0 * 5.0)) AS g FROM nn)
SELECT query_id, coalesce(sum(g) FILTER (result BETWEEN 2.0 AND 6.0), 0.0) / sum(g) AS prob FROM w GROUP BY 1""")
def n6_rows(spark, sf):
    """Weight share of the neighbours with a label in [2, 6], per query row."""
    near = _near(spark, sf).withColumn("result", F.col("result").between(2.0, 6.0).cast("double"))
    return NJ.estimates(near, N.WEIGHTS["gaussian"](F.col("distance"))).select("query_id", F.col("estimate").alias("prob"))


@register("n5_cross_validation", sql=f"""WITH {_JOIN_SQL.split("nn AS")[0].rstrip(", " + chr(10))},
trials AS (SELECT unnest(range(0, {TRIALS})) AS trial),
held AS (SELECT vec_id, label, trial FROM embeddings, trials
         WHERE ('0x' || substr(md5(vec_id || ':' || trial), 1, 8))::BIGINT % 100 < {PERCENT}),
near AS (SELECT q.vec_id, q.trial, q.label, d.result,
                row_number() OVER (PARTITION BY q.vec_id, q.trial ORDER BY d.distance, d.id) AS rank
         FROM held q JOIN dist d ON d.query_id = q.vec_id ANTI JOIN held h ON h.vec_id = d.id AND h.trial = q.trial),
guess AS (SELECT vec_id, trial, any_value(label)::DOUBLE AS actual, avg(result) AS estimate FROM near WHERE rank <= {K} GROUP BY 1, 2)
SELECT trial, count(*) AS n, avg((actual - estimate) * (actual - estimate)) AS error FROM guess GROUP BY 1""")
def n5(spark, sf):
    """Mean squared error of the estimate in ten trials with a tenth of the
    rows held out; tested are the held-out rows among the query rows."""
    return NJ.cross_validate(_rows(spark, sf), F.col("id") % 100 == 0, K, TRIALS, PERCENT)
