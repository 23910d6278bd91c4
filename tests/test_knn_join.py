import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import knn_join as NJ

SCHEMA = "id long, input array<float>, result double"


@pytest.fixture(scope="module")
def points():
    rnd = random.Random(2)
    centres = [[rnd.uniform(-5, 5) for _ in range(4)] for _ in range(6)]
    rows = [(i, [round(x + rnd.gauss(0, 0.5), 1) for x in rnd.choice(centres)], float(i % 7)) for i in range(500)]
    rows += [(500 + i, rows[3][1], 1.0) for i in range(120)]  # one place holds a large share, so distances tie
    return [*rows, (700, None, 1.0)]


def brute(points, queries, k, skip=lambda q, i: False):
    import numpy as np

    vec = {i: np.array(v, np.float32).astype(float) for i, v, _ in points if v is not None}
    out = {}
    for q in queries:
        if q in vec:
            ds = sorted((round(float(np.sqrt(((vec[i] - vec[q]) ** 2).sum())), 9), i) for i in vec if i != q and not skip(q, i))
            out[q] = [i for _, i in ds[:k]]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["id"]))
    return {q: [i for _, i in sorted(xs)] for q, xs in out.items()}


@pytest.mark.parametrize("pivots,block,chunk", [(64, 4096, 512), (3, 50, 7), (1, 40, 1000)])
def test_equals_brute_force(spark, points, pivots, block, chunk):
    data = spark.createDataFrame(points, SCHEMA).repartition(4)
    ask = [*range(0, 200), 550, 700]
    asked = data.where(F.col("id").isin(ask)).select(F.col("id").alias("query_id"), "input")
    assert found(NJ.nearest_join(data, asked, 5, pivots, block, chunk)) == brute(points, ask, 5)


def test_pruning_leaves_parts_out(spark, points):
    data = spark.createDataFrame(points, SCHEMA).where("input IS NOT NULL")
    pivots = NJ.choose_pivots(data, 16)
    rows = NJ._dealt(data.selectExpr("id", "cast(input as array<double>) input", "result", "0L AS held"), pivots).toPandas()
    import numpy as np

    radius, counts = np.full(16, -np.inf), np.zeros((16, 1), np.int64)
    for part, g in rows.groupby("part"):
        radius[part], counts[part] = g["off"].max(), len(g)
    asked = data.selectExpr("id AS query_id", "-1 AS trial", "cast(input as array<double>) vec")
    met = NJ._routed(asked, pivots, radius, counts, 5).count()
    assert met < 0.5 * 16 * data.count()


def test_cross_validation(spark, points):
    data = spark.createDataFrame(points, SCHEMA)
    trials, percent = 4, 30
    held = {r["id"]: r["h"] for r in data.select("id", NJ.held_out(F.col("id"), trials, percent).alias("h")).collect()}
    result = {i: r for i, _, r in points}
    got = {r["trial"]: (r["n"], r["error"]) for r in NJ.cross_validate(data, F.col("id") % 10 == 0, 5, trials, percent, n_pivots=8, block=64).collect()}
    for t in range(trials):
        ask = [i for i in held if i % 10 == 0 and held[i] >> t & 1]
        near = brute(points, ask, 5, lambda q, i, t=t: held[i] >> t & 1)
        errors = [(result[q] - sum(result[i] for i in ns) / len(ns)) ** 2 for q, ns in near.items()]
        assert got[t][0] == len(errors) and got[t][1] == pytest.approx(sum(errors) / len(errors))


def test_few_rows_and_none(spark):
    data = spark.createDataFrame([(1, [0.0], 2.0), (2, [1.0], 4.0)], SCHEMA)
    asked = spark.createDataFrame([(1, [0.0]), (9, [5.0])], "query_id long, input array<float>")
    assert found(NJ.nearest_join(data, asked, 5)) == {1: [2], 9: [2, 1]}
    assert NJ.nearest_join(data.limit(0), asked, 5).count() == 0
    assert NJ.nearest_join(data, asked.limit(0), 5).count() == 0
