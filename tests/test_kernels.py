import numpy as np
import pytest

from quarry.operators import kernels as K


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(scale=0.3, size=(300, 5)) + rng.integers(0, 2, size=(300, 1))
    label = rng.integers(0, 3, size=300)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label, strict=True))] + [(999, None, 1)],
                               "vec_id long, vec array<double>, label int").repartition(3)
    return x, label, df


@pytest.mark.parametrize("block,chunk", [(4096, 512), (40, 9)])
def test_decisions(rows, block, chunk):
    x, label, df = rows
    got = {r["query_id"]: r["y"] for r in K.kernel_decisions(df, df.selectExpr("vec_id AS query_id", "vec").where("query_id % 10 = 0"), 2.0, 0.1, block, chunk).collect()}
    k = lambda q, c: np.exp(-2.0 * ((x[label == c] - x[q]) ** 2).sum(axis=1)).mean()
    assert got == pytest.approx({q: k(q, 0) - k(q, 1) + 0.1 for q in range(0, 300, 10)})
    assert K.kernel_decisions(df, df.selectExpr("vec_id AS query_id", "vec").limit(0)).count() == 0


def test_offset(rows):
    x, label, df = rows
    mean = lambda c: np.exp(-2.0 * ((x[label == c][:, None] - x[label == c][None]) ** 2).sum(axis=2)).mean()
    assert K.kernel_offset(df, 2.0) == pytest.approx(mean(1) - mean(0), abs=0.01)
    assert K.kernel_offset(df.limit(0)) == 0.0


def test_rbf_classifier_beats_nearest_mean_on_rings(spark, tmp_path):
    """Held-out accuracy where both classes have the same mean; a run that
    was stopped goes on from its written state."""
    rng = np.random.default_rng(9)
    angle, label = rng.uniform(0, 2 * np.pi, 900), rng.integers(0, 2, 900)
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1) * (0.5 + label[:, None]) + rng.normal(scale=0.1, size=(900, 2))
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label, strict=True))] + [(1000, None, 1), (1001, [1.0, 0.0], 7)],
                               "query_id long, vec array<double>, label int").repartition(4)
    train, held = df.where("query_id % 3 <> 0"), df.where("query_id % 3 = 0")
    whole = K.train_rbf(train, gamma=2.0, rounds=40, state=f"{tmp_path}/state")
    got = {r["query_id"]: r["predicted"] for r in whole.predict(held).collect()}
    share = lambda f: np.mean([f(i) == label[i] for i in range(0, 900, 3)])
    rest = np.arange(900) % 3 != 0
    means = [x[rest & (label == c)].mean(axis=0) for c in (0, 1)]
    nearest = share(lambda i: int(((x[i] - means[1]) ** 2).sum() < ((x[i] - means[0]) ** 2).sum()))
    assert share(got.get) > 0.97 and nearest < 0.7
    assert len(got) == held.where("vec IS NOT NULL").count()
    again = K.train_rbf(train, gamma=2.0, rounds=43, state=f"{tmp_path}/state")
    assert np.allclose(again.weights, K.train_rbf(train, gamma=2.0, rounds=43).weights)
    assert not K.train_rbf(train.limit(0)).weights.any()
