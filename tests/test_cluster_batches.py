"""K-means: distances in batches against the expressions they stand for."""

import random

import pytest

from quarry.functions import vectors as V
from quarry.operators import cluster as CL


@pytest.mark.parametrize("name", ["euclidean", "pearson"])
def test_batched_distances_give_the_same_clusters(spark, name):
    """interpreted expressions per row and centroid, two passes a round before."""
    assert name in CL.BATCHED
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(2 * (i % 3), 0.7), rnd.gauss(-(i % 3), 0.7), rnd.gauss(0, 1), rnd.random()]) for i in range(80)]
    rows += [(90, None), (91, [1.0, 2.0]), (92, [1.0, None, 2.0, 3.0]), (93, [2.0] * 4)]
    df = spark.createDataFrame(rows, "id int, v array<float>").repartition(3)
    by_name, c1 = CL.kmeans(df, "id", "v", 3, name, seed=2)
    by_expression, c2 = CL.kmeans(df, "id", "v", 3, lambda a, b: getattr(V, f"{name}_distance" if name == "pearson" else name)(a, b), seed=2)
    assert by_name.schema == by_expression.schema
    assert {tuple(r) for r in by_name.collect()} == {tuple(r) for r in by_expression.collect()}
    assert [x for c in c1 for x in c] == pytest.approx([x for c in c2 for x in c])
