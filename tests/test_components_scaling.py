import random

import numpy as np
import pytest

from quarry.operators import contacts as C
from quarry.operators import graph as G
from quarry.operators import scaling as S
from quarry.operators.components import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in list(parent)}


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    edges = []
    for g in range(40):  # many small graphs side by side, a star, a loop, repeats
        for _ in range(rnd.randint(1, 25)):
            edges.append((g * 100 + rnd.randint(0, 30), g * 100 + rnd.randint(0, 30)))
    edges += [(9000, i) for i in range(8000, 8600)] + [(7, 7), (50_000, 50_000)] + edges[:50]
    df = spark.createDataFrame([*edges, (None, 1), (2, None)], "src long, dst long").repartition(5)
    assert {r["id"]: r["component"] for r in components(df).collect()} == brute(edges)
    assert components(df.limit(0)).count() == 0


def test_chain_of_titles_is_one_cluster(spark):
    n = 1000
    titles = [f"w{i} w{i + 1} w{i + 2}" for i in range(n)] + ["far away", "far off"]  # neighbours share 2 of 4 words
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = {r["member"]: r["cluster"] for r in C.level_clusters(df, "t").collect()}
    assert len(got) == n and len(set(got.values())) == 1
    assert C.similar_titles(df, "t").count() == 0  # none is nearer than one half


def test_closeness_against_exact_distances(spark):
    rnd = random.Random(6)
    edges = spark.createDataFrame([(i, rnd.randint(0, i)) for i in range(1, 300)] + [(1000, 1001)], "src long, dst long")
    levels = G.bfs_levels(edges, G.vertices(edges), directed=False).toPandas()
    n = levels["id"].nunique()
    exact = {s: (len(g) - 1) ** 2 / g["dist"].sum() / (n - 1) if len(g) > 1 else 0.0 for s, g in levels.groupby("source")}
    for lg_k, most in ((12, 0.02), (8, 0.2)):
        got = {r["id"]: r["closeness"] for r in G.closeness_centrality(edges, lg_k=lg_k).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[v] - exact[v]) <= most * exact[v] for v in exact)


def test_betweenness_in_batches(spark):
    rnd = random.Random(8)
    edges = spark.createDataFrame([(rnd.randint(0, 24), rnd.randint(0, 24)) for _ in range(60)], "src long, dst long")
    whole = {r["id"]: r["betweenness"] for r in G.betweenness_centrality(edges).collect()}
    parts = {r["id"]: r["betweenness"] for r in G.betweenness_centrality(edges, batch=9).collect()}
    assert parts == pytest.approx(whole)
    some = {r["id"]: r["betweenness"] for r in G.betweenness_centrality(edges, n_sources=12, batch=5).collect()}
    assert some.keys() == whole.keys() and sum(some.values()) == pytest.approx(sum(whole.values()), rel=0.6)


def test_scaling_of_200_rows(spark):
    rnd = np.random.default_rng(1)
    flat = rnd.normal(size=(200, 2)) * (4, 1)
    turn, _ = np.linalg.qr(rnd.normal(size=(6, 6)))
    for noise, most in ((0.0, 1e-6), (0.05, 0.1)):
        x = np.c_[flat, noise * rnd.normal(size=(200, 4))] @ turn
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(999, None)], "id long, vec array<double>").repartition(3)
        got = {r["id"]: r["place"] for r in S.landmark_scaling(df, "id", "vec").collect()}
        y = np.array([got[i] for i in range(200)])
        assert len(got) == 200
        d = lambda z: np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2))
        centred = x - x.mean(axis=0)
        u, s, _ = np.linalg.svd(centred, full_matrices=False)  # exact classical scaling
        error, best = (np.abs(d(z) - d(x)).mean() for z in (y, u[:, :2] * s[:2]))
        assert error < best + most


def test_scaling_of_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "id long, vec array<double>")
    assert sorted(tuple(r["place"]) for r in S.landmark_scaling(df, "id", "vec").collect()) == [(0.0, 0.0)] * 2
    assert S.landmark_scaling(df.limit(0), "id", "vec").count() == 0
