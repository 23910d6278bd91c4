"""Text mining and search operators against hand-derived values and brute force."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import search as S
from quarry.operators import text_mining as X
from quarry.operators.relational import global_rank

CORPUS = [
    ("a", "Mr. Green killed Colonel Mustard in the study with the candlestick. Mr. Green is not a very nice fellow."),
    ("b", "Professor Plum has a green plant in his study."),
    ("c", "Miss Scarlett watered Professor Plum's green plant while he was away from his office last week."),
]


def test_tfidf_query(spark):
    d = spark.createDataFrame(CORPUS, "doc_id string, text string")
    out = {r["doc_id"]: r["score"] for r in X.tfidf_query(d, ["mr.", "green"]).collect()}
    assert out["a"] == pytest.approx(0.3261697, abs=1e-6)
    assert out["b"] == pytest.approx(0.1111111, abs=1e-6)
    assert out["c"] == pytest.approx(0.0625, abs=1e-6)
    terms = X.ws_terms(d)
    n = d.count()
    idf = {r["term"]: r["idf"] for r in X.doc_freq(terms).select("term", X.idf_one_plus(n, F.col("df")).alias("idf")).collect()}
    assert idf["mr."] == pytest.approx(2.0986123, abs=1e-6)
    assert idf["green"] == pytest.approx(1.0, abs=1e-6)


def _brute_nearest(docs):
    toks = {k: t.lower().split() for k, t in docs}
    n = len(docs)
    df = {}
    for k, ts in toks.items():
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    vec = {k: {t: ts.count(t) / len(ts) * math.log(n / df[t]) for t in set(ts)} for k, ts in toks.items()}
    best = {}
    for a, b in itertools.permutations(vec, 2):
        dot = sum(w * vec[b].get(t, 0.0) for t, w in vec[a].items())
        na = math.sqrt(sum(w * w for w in vec[a].values()))
        nb = math.sqrt(sum(w * w for w in vec[b].values()))
        if dot == 0 or na == 0 or nb == 0:
            continue
        dist = round(1 - dot / (na * nb), 9)
        if dist < 1 and (a not in best or (dist, b) < best[a]):
            best[a] = (dist, b)
    return best


@pytest.mark.parametrize("block_postings", [1, 60, 200_000])
def test_nearest_documents_match_brute_force(spark, block_postings):
    rnd = random.Random(11)
    docs = [(i, " ".join(f"w{min(rnd.randint(0, 60), rnd.randint(0, 60))}" for _ in range(rnd.randint(3, 25)))) for i in range(40)]
    docs += [(40, docs[3][1]), (41, "all alone here"), (42, ""), (43, None)]  # a copy, one that shares no word, none at all
    d = spark.createDataFrame(docs, "doc_id long, text string")
    queries = d.where("doc_id % 3 = 0 OR doc_id > 39")
    got = {r["doc_id"]: (r["most_similar"], r["score"]) for r in X.nearest_documents(queries, d, block_postings=block_postings).collect()}
    best = _brute_nearest([(k, t or "") for k, t in docs])
    assert set(got) == {i for i, _ in docs if i % 3 == 0 or i > 39}
    for k, (near, score) in got.items():
        if k not in best:
            assert (near, score) == (None, 0.0)
        else:
            assert near == best[k][1] and score == pytest.approx(1 - best[k][0], abs=2e-9)
    assert got[40][0] == 3 and got[41][0] is None


@pytest.mark.parametrize("cells", [1, 40, 700, 4_000_000])
def test_block_search_in_steps_matches_whole_product(cells):
    rnd = np.random.default_rng(3)
    m = np.where(rnd.random((60, 30)) < np.linspace(0.02, 0.9, 30), rnd.integers(1, 4, (60, 30)), 0) * 0.1
    m[17] = m[4]                                            # equal distances: the smaller document is named
    rows = pd.DataFrame({"cand": np.arange(60) * 7, "tid": [np.flatnonzero(r) * 11 for r in m], "u": [r[r > 0] for r in m]})
    block = rows[rows["cand"] % 3 == 0].rename(columns={"cand": "q"})
    parts = pd.concat(X._nearest_in_block(block, cells)(iter([rows[25:].sample(frac=1, random_state=1), rows[:0], rows[:25]])))
    got = {q: min(zip(g["dist"], g["cand"], strict=True)) for q, g in parts.groupby("q")}
    for q in block["q"]:
        d = {c: round(1 - float(m[c // 7] @ m[q // 7]), 9) for c in rows["cand"] if c != q}
        near = min((x, c) for c, x in d.items())
        assert got.get(q, (1, None))[1] == (near[1] if near[0] < 1 else None)


def test_similarity_graph(spark):
    d = spark.createDataFrame([(5, "a b c x"), (9, "a b c y"), (12, "p q"), (20, "z")], "doc_id long, text string")
    nodes, links = X.similarity_graph(d.where("doc_id <> 12"), d, F.upper("text"))
    assert [tuple(r) for r in nodes.orderBy("idx").collect()] == [(0, 5, "A B C X"), (1, 9, "A B C Y"), (2, 12, "P Q"), (3, 20, "Z")]
    got = {r["source"]: (r["target"], r["score"] > 0) for r in links.collect()}
    assert got == {0: (1, True), 1: (0, True), 3: (None, False)}
    none = d.limit(0)
    assert X.nearest_documents(none, d).collect() == [] and X.nearest_documents(none, none).collect() == []


def test_most_similar_blocks_match_brute_force(spark):
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 25)))) for i in range(30)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["most_similar"], r["score"]) for r in X.most_similar(d, block_docs=7).collect()}
    want = _brute_nearest(docs)
    for k in range(30):
        if k in want:
            assert got[k][0] == want[k][1]
            assert got[k][1] == pytest.approx(1 - want[k][0], abs=1e-9)
        else:
            assert got[k][0] is None


def test_most_similar_in_lots_of_block_pairs(spark):
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9)))) for i in range(24)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    whole, lots = (sorted(map(tuple, X.most_similar(d, block_docs=5, lot_rows=n).collect())) for n in (10**9, 200))
    assert len(whole) == 24 and whole == lots


def test_distance_score_matches_match_rows(spark):
    rnd = random.Random(3)
    words = ["x", "y", "z", "q"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(2, 30)))) for i in range(20)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    wl = S.word_locations(d, "doc_id", F.col("text"))
    q = ["x", "y", "z"]
    summ = {r["urlid"]: r for r in S.match_summary(wl, q).collect()}
    rows = S.match_rows(wl, q).collect()
    brute = {}
    for r in rows:
        locs = [r[f"loc{i}"] for i in range(3)]
        dist = sum(abs(locs[i] - locs[i - 1]) for i in range(1, 3))
        b = brute.setdefault(r["urlid"], [0, 10 ** 9, 10 ** 9])
        b[0] += 1
        b[1] = min(b[1], sum(locs))
        b[2] = min(b[2], dist)
    assert set(summ) == set(brute)
    for u, (n, loc, dist) in brute.items():
        assert summ[u]["log_rows"] == pytest.approx(math.log(n)) and summ[u]["loc_sum"] == loc and summ[u]["min_dist"] == dist


def test_pagerank_fixed_point_on_cycle(spark):
    link = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "fromid string, toid string")
    urls = S.url_list(link)
    pr = {r["urlid"]: r["score"] for r in S.pagerank(link, urls, 20).collect()}
    assert all(v == pytest.approx(1.0, abs=1e-9) for v in pr.values())


def test_click_network_untrained_output(spark):
    wh = spark.createDataFrame([(101, 1, 0.5), (103, 1, 0.5)], "fromid long, toid long, strength double")
    hu = spark.createDataFrame([(1, u, 0.1) for u in (201, 202, 203)], "fromid long, toid long, strength double")
    words = spark.createDataFrame([(0, 101), (0, 103)], "query_id int, word long")
    urls = spark.createDataFrame([(0, u) for u in (201, 202, 203)], "query_id int, urlid long")
    out = S.nn_scores(wh, hu, words, urls).collect()
    assert len(out) == 3
    assert all(r["score"] == pytest.approx(0.0760128, abs=1e-6) for r in out)


def test_global_rank_is_total_order(spark):
    df = spark.createDataFrame([(w, n) for w, n in [("b", 3), ("a", 3), ("c", 1), ("d", 7)]], "word string, n long")
    got = [(r["word"], r["rank"]) for r in global_rank(df, [F.desc("n"), F.asc("word")]).orderBy("rank").collect()]
    assert got == [("d", 1), ("a", 2), ("b", 3), ("c", 4)]


def test_luhn_cluster_score(spark):
    d = spark.createDataFrame([(1, "alpha beta gamma. beta beta alpha delta alpha.")], "doc_id long, text string")
    s = X.sentence_scores(d, n_words=2).orderBy("sent_idx").collect()
    # important words: alpha (3), beta (3); sentence 0: positions 0,1 -> 2*2/2 = 2
    assert s[0]["score"] == pytest.approx(2.0)
