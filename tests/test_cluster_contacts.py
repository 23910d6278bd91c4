"""K-means, title similarity, click training, file conversions and function
arguments against brute force."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.operators import cluster as CL
from quarry.operators import contacts as CO
from quarry.operators import graph as G
from quarry.operators import knn as N
from quarry.operators import search as S
from quarry.sources import files as IO


def brute_kmeans(rows, k, seed):
    dims = len(rows[0][1])
    rnd = random.Random(seed)
    cents = [[min(r[1][i] for r in rows) + rnd.random() * (max(r[1][i] for r in rows) - min(r[1][i] for r in rows)) for i in range(dims)] for _ in range(k)]
    last = None
    for _ in range(100):
        got = [min(range(k), key=lambda c: (math.dist(v, cents[c]), c)) for _, v in rows]
        if got == last:
            break
        last = got
        for c in range(k):
            mine = [v for (_, v), g in zip(rows, got, strict=True) if g == c]
            if mine:
                cents[c] = [sum(x) / len(mine) for x in zip(*mine, strict=True)]
    return {i: g for (i, _), g in zip(rows, last, strict=True)}


@pytest.mark.parametrize("distance", ["euclidean", lambda a, b: V.euclidean(a, b)])
def test_kmeans(spark, distance):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(3 * (i % 3), 0.6), rnd.gauss(-2 * (i % 3), 0.6)]) for i in range(60)]
    got, cents = CL.kmeans(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", 3, distance, seed=5)
    assert {r["id"]: r["cluster"] for r in got.collect()} == brute_kmeans(rows, 3, 5)
    assert len(cents) == 3


def test_weighted_kmeans_counts_rows(spark):
    rows = [("a", 0.0, 0.0, 10.0), ("b", 1.0, 0.0, 1.0), ("c", 50.0, 50.0, 5.0)]
    df, cents = CL.weighted_kmeans(spark.createDataFrame(rows, "id string, x double, y double, f double"), ["x", "y"], "f", 2)
    by = {r["id"]: r["cluster"] for r in df.collect()}
    assert by["a"] == by["b"] != by["c"] and any(c[0] == pytest.approx(1 / 11) for c in cents)


@pytest.mark.parametrize("distance", [0.3, 0.5, 0.75])
def test_similar_titles(spark, distance):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["the"] * 6
    titles = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(60)] + ["", None, "the the"]
    got = {(r["a"], r["b"]) for r in CO.similar_titles(spark.createDataFrame([(t,) for t in titles], "t string"), "t", distance).collect()}
    sets = {t: set(t.split()) for t in titles if t}
    want = {(a, b) for a in sets for b in sets if a < b and 1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < distance - 1e-12}
    assert got == want


def test_click_training_follows_the_gradient(spark):
    """One query trained alone equals a step by hand."""
    words = spark.createDataFrame([(0, "w"), (0, "x")], "query_id int, word string")
    urls = spark.createDataFrame([(0, u) for u in "abc"], "query_id int, urlid string")
    clicks = spark.createDataFrame([(0, "a")], "query_id int, urlid string")
    wh, hu = S.click_network(words, urls)
    assert {(r["fromid"], r["strength"]) for r in wh.collect()} == {("w", 0.5), ("x", 0.5)}
    wh2, hu2 = S.train_clicks(wh, hu, words, urls, clicks)
    ah = math.tanh(1.0)
    ao = math.tanh(0.1 * ah)
    od = {u: (1 - ao * ao) * ((u == "a") - ao) for u in "abc"}
    hd = (1 - ah * ah) * sum(od[u] * 0.1 for u in "abc")
    assert {r["toid"]: r["strength"] for r in hu2.collect()} == pytest.approx({u: 0.1 + 0.5 * od[u] * ah for u in "abc"})
    assert {r["fromid"]: r["strength"] for r in wh2.collect()} == pytest.approx({"w": 0.5 + 0.5 * hd, "x": 0.5 + 0.5 * hd})
    for _ in range(3):
        wh2, hu2 = S.train_clicks(wh2, hu2, words, urls, clicks)
    score = {r["urlid"]: r["score"] for r in S.nn_scores(wh2, hu2, words, urls).collect()}
    assert score["a"] > 0.4 > score["b"] == pytest.approx(score["c"])


def test_weight_function_argument(spark):
    data = spark.createDataFrame([(i, [float(i)], float(i * 10)) for i in range(10)], "id int, input array<double>, result double")
    by_name = N.weighted_knn(data, [3.2], 3, "inverse").first()[0]
    assert N.weighted_knn(data, [3.2], 3, lambda d: V.inverse_weight(d)).first()[0] == pytest.approx(by_name)


def test_mutual_friends(spark):
    e = spark.createDataFrame([(0, 1), (0, 2), (3, 0), (1, 2), (2, 4), (3, 4)], "src int, dst int")
    got = {r["friend"]: r["mutual"] for r in G.mutual_friends(e, 0).collect()}
    assert got == {1: [2], 2: [1], 3: []}


def test_interest_graph_keeps_the_first_items(spark):
    likes = spark.createDataFrame([("u", f"i{k}") for k in range(9)] + [("v", "i1"), ("v", "i1")], "u string, i string")
    nodes, edges = G.interest_graph(likes, "u", "i", most=4)
    assert sorted((r["src"], r["dst"]) for r in edges.collect()) == [("u", f"i{k}") for k in range(4)] + [("v", "i1")]
    assert nodes.count() == 6


def test_mail_folders_to_mbox(spark, tmp_path):
    mail = "From: A <a@x>\nTo: b@x\nSubject: One\nDate: Mon, 1 Dec 2025 10:00:00 -0500\n\nbody\n"
    for box in ("u1/inbox", "u1/sent", "u2/inbox"):
        os.makedirs(f"{tmp_path}/mails/{box}")
        with open(f"{tmp_path}/mails/{box}/1.", "w") as f:
            f.write(mail)
    rows = IO.mails_to_mbox(spark, f"{tmp_path}/mails")
    assert rows.count() == 2 and rows.first()["value"].startswith("From a@x Mon Dec 01 15:00:00 2025\n")
    rows.select("value").write.text(f"{tmp_path}/mbox")
    back = IO.read_mbox(spark, f"{tmp_path}/mbox").collect()
    assert [r["Subject"] for r in back] == ["One", "One"] and back[0]["Date"].hour == 15


def test_hierarchy_rows_are_bounded(spark):
    df = spark.createDataFrame([("group", f"m{i:04d}") for i in range(25)], "g string, m string")
    rows = sorted(IO.hierarchy_json(df, "g", "m", chunk=10).collect(), key=lambda r: r["part"])
    assert [r["part"] for r in rows] == [0, 1, 2] and rows[2]["json"].count('"name":"m') == 5


def test_any_feature_column_as_extractor(spark):
    """The features of a classifier are any array expression."""
    from quarry.operators import classify as C

    items = spark.createDataFrame([("a b", "x"), ("b c", "y")], "t string, cat string").withColumn("pairs", F.split("t", " "))
    fc, _ = C.train_counts(items, F.transform("pairs", lambda w: F.upper(w)), "cat")
    assert {r["feature"] for r in fc.collect()} == {"A", "B", "C"}


def test_sketched_titles_find_nearly_all_near_pairs(spark):
    """Every pair found is near, and 0.9 of the near pairs or more are found;
    every title is in the index."""
    rnd = random.Random(4)
    vocab = ["chief", "senior", "junior", "sales", "data", "cloud", "risk", "field", "lead", "staff", "manager", "engineer", "analyst", "officer"]
    titles = [" ".join(rnd.sample(vocab, rnd.randint(1, 6))) for _ in range(400)] + [None, "", "sales lead"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    near = {tuple(r) for r in CO.title_clusters(df, "title").collect()}
    got = [tuple(r) for r in CO.sketched_clusters(df, "title").collect()]
    assert len(got) == len(set(got)) and set(got) <= near and len(got) >= 0.9 * len(near)
    index = CO.title_sketches(df, "title", bands=5)
    assert index.count() == 5 * len({t for t in titles if t}) and index.select("t").distinct().count() == len({t for t in titles if t})
    few = CO.sketched_clusters(df, "title", bands=1, rows=3).count()
    assert few < len(got)


def test_placemarks(spark):
    from quarry.operators.contacts import placemarks

    names = [f"n{i % 7}" for i in range(25)]
    people = spark.createDataFrame([("x", n) for n in names] + [("y", "solo"), ("y", None), ("nowhere", "lost"), (None, "lost")], "at string, who string")
    places = spark.createDataFrame([("x", 1.5, -2.0), ("y", 0.0, 3.25), ("empty", 9.0, 9.0)], "label string, lat double, lon double")
    means = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "lat double, lon double")
    got = [tuple(r) for r in placemarks(people, "at", "who", places, means, chunk=10).collect()]
    rows = sorted(r for r in got if r[0] != "CENTROID")
    assert [r[:3] for r in rows] == [("x", 0, "-2.0,1.5"), ("x", 1, "-2.0,1.5"), ("x", 2, "-2.0,1.5"), ("y", 0, "3.25,0.0")]
    assert [n for r in rows[:3] for n in r[3].split("\n")] == sorted(names) and rows[3][3] == "\nsolo"
    assert [r for r in got if r[0] == "CENTROID"] == [("CENTROID", 0, "2.0,1.0", None)] * 2
    assert placemarks(people.limit(0), "at", "who", places.limit(0), means.limit(0)).collect() == []
