"""Recommendation operators on the critics fixture and invariants."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import recommend as R
from quarry.operators.dist import pair_join

CRITICS = {
    "Lisa Rose": {"Lady in the Water": 2.5, "Snakes on a Plane": 3.5, "Just My Luck": 3.0,
                  "Superman Returns": 3.5, "You, Me and Dupree": 2.5, "The Night Listener": 3.0},
    "Gene Seymour": {"Lady in the Water": 3.0, "Snakes on a Plane": 3.5, "Just My Luck": 1.5,
                     "Superman Returns": 5.0, "The Night Listener": 3.0, "You, Me and Dupree": 3.5},
    "Toby": {"Snakes on a Plane": 4.5, "You, Me and Dupree": 1.0, "Superman Returns": 4.0},
}


@pytest.fixture
def prefs(spark):
    rows = [(u, i, r) for u, d in CRITICS.items() for i, r in d.items()]
    return spark.createDataFrame(rows, "user_id string, item_id string, rating double")


def test_pearson_and_distance(prefs):
    p = R.sim_pair(prefs, "Lisa Rose", "Gene Seymour", "pearson").first()["score"]
    d = R.sim_pair(prefs, "Lisa Rose", "Gene Seymour", "distance").first()["score"]
    assert p == pytest.approx(0.3960590, abs=1e-6)
    assert d == pytest.approx(0.1481481, abs=1e-6)


def test_no_overlap_scores_zero(prefs, spark):
    extra = spark.createDataFrame([("Nobody", "Other film", 1.0)], prefs.schema)
    p = prefs.unionByName(extra)
    assert R.sim_pair(p, "Nobody", "Toby", "pearson").first()["score"] == 0.0


def test_similar_items_symmetric_and_bounded(prefs):
    s = R.similar_items(prefs, n=2).collect()
    per = {}
    for r in s:
        per.setdefault(r["item_id"], []).append(r)
        assert 0 < r["similarity"] <= 1
    assert all(len(v) <= 2 for v in per.values())


def test_item_recommendations_unrated_only(prefs):
    im = R.similar_items(prefs, n=10)
    rec = R.item_recommendations(prefs, im).where(F.col("user_id") == "Toby").collect()
    rated = set(CRITICS["Toby"])
    assert rec and all(r["item_id"] not in rated for r in rec)


def test_pair_join_in_a_grid_matches_plain_join(spark):
    rows = [(1, i) for i in range(30)] + [(2, i) for i in range(3)]
    a = spark.createDataFrame(rows, "k int, x int")
    b = spark.createDataFrame(rows, "k int, y int")
    salted = pair_join(a, b, "k", heavy_rows=5).select("k", "x", "y")
    plain = a.join(b, "k").select("k", "x", "y")
    assert sorted(salted.collect()) == sorted(plain.collect())


def _odd_prefs(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(30) for i in range(12) if (u + i) % 3] + [(3, 99, None), (None, 2, 1.0), (4, None, 2.0), (None, 50, 3.0)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_similar_items_in_lots_match_the_pairs_join(spark):
    prefs = _odd_prefs(spark)
    sums = R.item_pair_sums(prefs, measures=["sq"]).collect()
    near = {}
    for r in sums:
        for a, b in ((r["item_a"], r["item_b"]), (r["item_b"], r["item_a"])):
            near.setdefault(a, []).append((r["sq"] is None, 0 if r["sq"] is None else round(r["sq"], 9), -b))
    want = {a: [-x[2] for x in sorted(v)[:3]] for a, v in near.items()}
    for lot_pairs, heavy in ((10**9, 4000), (500, 16)):
        got = {}
        for r in sorted(R.similar_items(prefs, 3, heavy, lot_pairs).collect(), key=lambda r: (r["item_id"], r["rank"])):
            got.setdefault(r["item_id"], []).append(r["other_item"])
        assert got == want


def test_recommendations_match_the_anti_join(spark):
    prefs, near = _odd_prefs(spark), R.similar_items(_odd_prefs(spark), 3)
    j = prefs.join(near, "item_id").select("user_id", F.col("other_item").alias("item_id"), "rating", "similarity")
    j = j.join(prefs.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    want = {(r[0], r[1]): r[2] for r in j.groupBy("user_id", "item_id").agg(F.sum(F.col("similarity") * F.col("rating")) / F.sum("similarity")).collect()}
    got = {(r[0], r[1]): r[2] for r in R.item_recommendations(prefs, near).collect()}
    assert got.keys() == want.keys() and any(u is None for u, _ in got)
    assert all(got[k] == want[k] or got[k] == pytest.approx(want[k]) for k in want)


def test_written_tables_leave_no_shuffle_files(spark, monkeypatch):
    from quarry import session

    seen = []
    frame = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    monkeypatch.setattr(session, "scratch_path", lambda s, name: seen.append(s.conf.get(session.CLEANUP_CONF, "false")) or "/dev/null/none")
    with pytest.raises(Exception):
        session.cut_lineage(frame)
    assert spark.conf.get(session.CLEANUP_CONF) == "false" and seen == ["false"]
    monkeypatch.undo()
    assert session.cut_lineage(frame).count() == 7
