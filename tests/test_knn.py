"""Numeric prediction helpers."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.operators import knn as N


def test_wine_price_and_weights(spark):
    df = spark.createDataFrame([(99.0, 5.0)], "rating double, age double")
    assert df.select(N.wine_price("rating", "age")).first()[0] == pytest.approx(30.3061224, abs=1e-6)
    d = spark.createDataFrame([(0.1,), (1.0,), (3.0,)], "d double")
    g = [r[0] for r in d.select(V.gaussian(F.col("d"), 5.0)).collect()]
    assert g == pytest.approx([0.9998000, 0.9801987, 0.8352702], abs=1e-6)
    assert d.select(V.inverse_weight(F.col("d"))).first()[0] == pytest.approx(5.0)
    assert [r[0] for r in d.select(V.subtract_weight(F.col("d"))).collect()] == pytest.approx([0.9, 0.0, 0.0])


def test_knn_ties_by_id(spark):
    data = spark.createDataFrame([(i, [float(i % 2)], float(i)) for i in range(6)], "id long, input array<double>, result double")
    near = [r["id"] for r in N.nearest(data, [0.0], 2).collect()]
    assert near == [0, 2]
    assert N.knn_estimate(data, [0.0], 3).first()["estimate"] == pytest.approx((0 + 2 + 4) / 3)


def test_random_split_is_repeatable(spark):
    data = spark.range(1000).withColumnRenamed("id", "id")
    a = {r.id for r in N.random_split(data, "id", 0.1, 7)[1].collect()}
    b = {r.id for r in N.random_split(data.repartition(5), "id", 0.1, 7)[1].collect()}
    assert a == b and 50 < len(a) < 150
