"""Trees against a recursive brute force on the 16-row customer fixture."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import trees as TR

# The worked example (referrer, location, read FAQ, pages, service).
ROWS = [("slashdot", "USA", "yes", 18, "None"), ("google", "France", "yes", 23, "Premium"), ("digg", "USA", "yes", 24, "Basic"),
        ("kiwitobes", "France", "yes", 23, "Basic"), ("google", "UK", "no", 21, "Premium"), ("(direct)", "New Zealand", "no", 12, "None"),
        ("(direct)", "UK", "no", 21, "Basic"), ("google", "USA", "no", 24, "Premium"), ("slashdot", "France", "yes", 19, "None"),
        ("digg", "USA", "no", 18, "None"), ("google", "UK", "no", 18, "None"), ("kiwitobes", "UK", "no", 19, "None"),
        ("digg", "New Zealand", "yes", 12, "Basic"), ("slashdot", "UK", "no", 21, "None"), ("google", "UK", "yes", 18, "Basic"),
        ("kiwitobes", "France", "yes", 19, "Basic")]
FEATURES = ["referrer", "location", "faq", "pages"]
SCHEMA = "referrer string, location string, faq string, pages int, service string"


def entropy(rows):
    c = Counter(r[-1] for r in rows)
    return -sum(v / len(rows) * math.log2(v / len(rows)) for v in c.values()) if rows else 0.0


def gini(rows):
    c = Counter(r[-1] for r in rows)
    return 1 - sum((v / len(rows)) ** 2 for v in c.values()) if rows else 0.0


def variance(rows):
    if not rows:
        return 0.0
    m = sum(r[-1] for r in rows) / len(rows)
    return sum((r[-1] - m) ** 2 for r in rows) / len(rows)


def goes_true(row, col, value):
    if row[col] is None:
        return False
    return row[col] >= value if isinstance(value, (int, float)) else row[col] == value


def brute(rows, score, node="r", depth=0, most=None, out=None):
    out = {} if out is None else out
    best = None
    if most is None or depth < most:
        for col in range(len(rows[0]) - 1):
            for value in sorted({r[col] for r in rows if r[col] is not None}):
                t = [r for r in rows if goes_true(r, col, value)]
                f = [r for r in rows if not goes_true(r, col, value)]
                p = len(t) / len(rows)
                gain = score(rows) - p * score(t) - (1 - p) * score(f)
                if t and f and gain > 1e-12 and (best is None or round(gain, 9) > round(best[0], 9)):
                    best = gain, col, value, t, f
    if best is None:
        out[node] = dict(Counter(str(r[-1]) for r in rows))
        return out
    out[node] = best[1], best[2]
    brute(best[3], score, node + "T", depth + 1, most, out)
    brute(best[4], score, node + "F", depth + 1, most, out)
    return out


def as_dict(tree, features):
    out = {}
    for r in tree.collect():
        if r["is_leaf"]:
            out[r["node"]] = r["results"]
        else:
            out[r["node"]] = features.index(r["col"]), r["vstr"] if r["vstr"] is not None else r["vnum"]
    return out


@pytest.mark.parametrize("name,score", [("entropy", entropy), ("gini", gini)])
def test_whole_tree(spark, name, score):
    tree = TR.build_tree(spark.createDataFrame(ROWS, SCHEMA), FEATURES, "service", name)
    assert as_dict(tree, FEATURES) == brute(ROWS, score)


def test_first_split_of_the_worked_example(spark):
    s = TR.best_splits(TR.root_rows(spark.createDataFrame(ROWS, SCHEMA), [*FEATURES, "service"]), FEATURES, "service").first()
    assert (s["col"], s["vstr"], s["n"]) == ("referrer", "google", 16)


def test_classify_with_and_without_missing_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tree = TR.build_tree(df, FEATURES, "service").cache()
    nodes = as_dict(tree, FEATURES)
    asked = [(1, "(direct)", "USA", "yes", 5), (2, "google", None, "yes", None), (3, "google", "France", None, None), (4, None, None, None, None),
             (5, None, "UK", "no", 21)]
    q = spark.createDataFrame(asked, "id int, referrer string, location string, faq string, pages int")

    def follow(row, node):
        got = nodes[node]
        if isinstance(got, dict):
            return dict(got)
        col, value = got
        if row[col + 1] is None:
            t, f = follow(row, node + "T"), follow(row, node + "F")
            tn, fn = sum(t.values()), sum(f.values())
            return {k: t.get(k, 0) * tn / (tn + fn) + f.get(k, 0) * fn / (tn + fn) for k in {*t, *f}}
        return follow(row, node + ("T" if goes_true(row[1:], col, value) else "F"))

    got = {}
    for r in TR.classify_missing(tree, q, FEATURES, "id").collect():
        got.setdefault(r["id"], {})[r["class"]] = r["weight"]
    for row in asked:
        assert got[row[0]] == pytest.approx(follow(row, "r"))
    plain = {r["id"]: r["results"] for r in TR.classify(tree, q, FEATURES, "id").collect()}
    assert plain[1] == {"Basic": 4}


def test_prune_keeps_some_and_merges_some(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tree = TR.build_tree(df, FEATURES, "service").cache()
    nodes = as_dict(tree, FEATURES)

    def prune(least):
        out = dict(nodes)

        def h(c):
            n = sum(c.values())
            return -sum(v / n * math.log2(v / n) for v in c.values())

        for node in sorted((x for x in nodes if not isinstance(nodes[x], dict)), key=lambda x: -len(x)):
            t, f = out[node + "T"], out[node + "F"]
            if isinstance(t, dict) and isinstance(f, dict):
                both = dict(Counter(t) + Counter(f))
                if h(both) - (h(t) + h(f)) / 2 < least:
                    out[node] = both
                    del out[node + "T"], out[node + "F"]
        return out

    sizes = set()
    for least in (0.1, 0.95, 1.1, 5.0):
        got = as_dict(TR.prune(tree, least), FEATURES)
        assert got == prune(least)
        sizes.add(len(got))
    assert len(sizes) >= 3 and min(sizes) == 1


def test_regression_tree_keeps_moments(spark):
    rows = [(i % 4, float(i), float(i // 5 * 100 + i % 3)) for i in range(60)]
    tree = TR.build_tree(spark.createDataFrame(rows, "a int, b double, y double"), ["a", "b"], "y", "variance", 3)
    want = brute(rows, variance, most=3)
    got = {r["node"]: r for r in tree.collect()}
    assert set(got) == set(want)
    for node, w in want.items():
        if isinstance(w, dict):
            ys = [float(k) for k, n in w.items() for _ in range(n)]
            mean = sum(ys) / len(ys)
            assert got[node]["results"] is None and got[node]["n"] == len(ys) and got[node]["mean"] == pytest.approx(mean)
            assert got[node]["var"] == pytest.approx(sum((y - mean) ** 2 for y in ys) / len(ys), abs=1e-6)
        else:
            assert (["a", "b"].index(got[node]["col"]), got[node]["vnum"]) == w


def test_running_sums_over_ranges(spark):
    df = spark.createDataFrame([(k, float(v), v * k) for k in (1, 2, 3) for v in range(200)], "k int, v double, x long")
    for r in TR.running_sums(df, ["k"], "v", ["x"]).collect():
        assert r["run_x"] == sum(u * r["k"] for u in range(int(r["v"]), 200))


def test_tree_of_seventy_levels(spark):
    """Node names are paths, so depth has no limit."""
    n = 70
    deep = spark.createDataFrame([("r" + "F" * i + "T", i + 1, None, None, None, True, {"a": 1}, 1, None, None) for i in range(n)]
                                 + [("r" + "F" * n, n, None, None, None, True, {"b": 1}, 1, None, None)]
                                 + [("r" + "F" * i, i, "x", float(n - i), None, False, None, 1, None, None) for i in range(n)],
                                 "node string, depth int, col string, vnum double, vstr string, is_leaf boolean, results map<string,bigint>, n long, mean double, var double")
    q = spark.createDataFrame([(1, 0), (2, n), (3, 1)], "id int, x int")
    got = {r["id"]: r["node"] for r in TR.classify(deep, q, ["x"], "id").collect()}
    assert got == {1: "r" + "F" * n, 2: "rT", 3: "r" + "F" * (n - 1) + "T"}
    assert TR.tree_shape(deep).first()["depth"] == n


@pytest.mark.parametrize("name,score", [("entropy", entropy), ("gini", gini), ("variance", variance)])
@pytest.mark.parametrize("local_rows", [5, 1000])
def test_subtrees_in_tasks_equal_brute_force(spark, name, score, local_rows):
    """Whole trees, by levels above and in tasks below, with missing values and
    many classes."""
    rnd = random.Random(6)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1.0, 2.0, 2.5, 7.0]), rnd.randint(0, 9), rnd.choice([1.0, 2.0, 5.0, 11.0])) for _ in range(45)]
    if name != "variance":
        rows = [(*r[:3], None if rnd.random() < 0.1 else f"k{int(r[3])}") for r in rows]
    kind = "double" if name == "variance" else "string"
    df = spark.createDataFrame(rows, f"a string, b double, c int, y {kind}")
    got = TR.build_tree(df, ["a", "b", "c"], "y", name, local_rows=local_rows).collect()
    want = brute(rows, score)
    assert {r["node"] for r in got} == set(want) and len(got) == len(want) > 15
    for r in got:
        w = want[r["node"]]
        if not r["is_leaf"]:
            assert (["a", "b", "c"].index(r["col"]), r["vstr"] if r["vstr"] is not None else r["vnum"]) == w
        elif name == "variance":
            assert r["n"] == sum(w.values()) and r["results"] is None
            assert r["mean"] == pytest.approx(sum(float(k) * n for k, n in w.items()) / r["n"])
        else:
            assert r["results"] == {"null" if k == "None" else k: n for k, n in w.items()}


def test_subtrees_keep_a_depth_limit_and_an_empty_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tree = TR.build_tree(df, FEATURES, "service", "gini", max_depth=2, local_rows=100)
    assert as_dict(tree, FEATURES) == brute(ROWS, gini, most=2)
    assert TR.build_tree(df.limit(0), FEATURES, "service", local_rows=100).count() == 0


def test_missing_values_are_merged_once_for_each_set_of_leaves(spark, monkeypatch):
    rows = ROWS * 20
    df = spark.createDataFrame(rows, SCHEMA)
    tree = TR.build_tree(df, FEATURES, "service", max_depth=1)
    wide = df.withColumn("id", F.monotonically_increasing_id()).withColumn(FEATURES[0], F.when(F.col("id") % 2 == 0, F.col(FEATURES[0])))
    sizes, cut = [], TR.cut_lineage
    monkeypatch.setattr(TR, "cut_lineage", lambda d: sizes.append(d.columns) or cut(d))
    out = TR.classify_missing(tree, wide, FEATURES, "id")
    assert out.select("id").distinct().count() == len(rows)
    # from the routed rows on, only leaf sets are merged
    merged = sizes[sizes.index(["id", "nodes"]) + 1:]
    assert merged and all("id" not in c for c in merged)


@pytest.mark.parametrize("score,label", [("entropy", "y"), ("gini", "y"), ("variance", "z")])
def test_large_nodes_over_parts_match_one_task(spark, score, label, monkeypatch):
    from quarry.operators import levels

    monkeypatch.setattr(levels, "PART_ROWS", 60)
    monkeypatch.setattr(levels, "FEW", 10)
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["u", "v", None]), rnd.randint(1, 5), rnd.choice([None, *[round(rnd.uniform(0, 9), 1)] * 9]),
             rnd.choice(["A", "B", None]), rnd.choice([None, *[float(rnd.randint(0, 9))] * 9])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a string, b int, c double, y string, z double")
    features = ["a", "b", "c"]

    def table(tree):
        return sorted((r["node"], r["depth"], r["col"] or "", r["vnum"] or 0, r["vstr"] or "", r["is_leaf"], sorted((r["results"] or {}).items()), r["n"],
                       round(r["mean"] or 0, 6), round(r["var"] or 0, 6)) for r in tree.collect())

    whole = TR.build_tree(df, features, label, score, local_rows=1000)
    parts = TR.build_tree(df, features, label, score, local_rows=40)
    assert table(parts) == table(whole)
    assert table(TR.build_tree(df, features, label, score, max_depth=2, local_rows=40)) == table(TR.build_tree(df, features, label, score, max_depth=2))
    routed = TR._walked(parts, df, features, "id", 40).collect()
    assert sorted((r["id"], r["node"]) for r in routed) == sorted((r["id"], r["node"]) for r in TR._routed(parts, df, features, "id", False).collect())
    if score == "entropy":
        for min_gain in (0.4, 0.7, 2.0):
            assert table(TR.prune(parts, min_gain, part_rows=40)) == table(TR.prune(parts, min_gain))


def _orders(spark, n, seed=5):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["u", "v", None]), rnd.randint(1, 5), rnd.choice([None, float("nan"), *[round(rnd.uniform(0, 9), 1)] * 9]),
             rnd.choice(["A", "B", None])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a string, b int, c double, y string"), ["a", "b", "c"]


def _nodes(tree):
    return sorted((r["node"], r["depth"], r["col"] or "", r["vnum"] or 0, r["vstr"] or "", r["is_leaf"], sorted((r["results"] or {}).items()), r["n"])
                  for r in tree.collect())


@pytest.mark.parametrize("score,counted", [("entropy", 10), ("gini", 3)])       # one feature of many values, or two
def test_large_nodes_in_one_barrier_stage(spark, score, counted, monkeypatch):
    """A chain of large nodes takes no jobs a level, and gives the same tree
    as levels by jobs and as one task."""
    from quarry.operators import levels

    df, features = _orders(spark, 400)
    whole = _nodes(TR.build_tree(df, features, "y", score, local_rows=1000))
    monkeypatch.setattr(levels, "PART_ROWS", 60)
    monkeypatch.setattr(levels, "FEW", counted)
    monkeypatch.setattr(levels, "NODE_ROWS", 30)
    jobs = {}
    for way, cores in (("stage", levels._cores(spark)), ("jobs", 0)):
        monkeypatch.setattr(levels, "_cores", lambda s, c=cores: c)
        spark.sparkContext.setJobGroup(way, way)
        assert _nodes(TR.build_tree(df, features, "y", score, local_rows=20)) == whole
        jobs[way] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(way))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    large = max(n[1] for n in whole if n[7] > 30 and not n[5])
    assert large >= 5 and jobs["stage"] <= jobs["jobs"] - 3 * large


@pytest.mark.parametrize("score", ["entropy", "gini"])
def test_many_nodes_grown_at_once_as_one_by_one(score, monkeypatch):
    import pandas as pd

    from quarry.operators import subtrees

    rnd = random.Random(8)
    rows = pd.DataFrame([(rnd.choice(["rT", "rFF", "rFT"]), rnd.choice([None, "a", "b"]), rnd.choice([None, *range(30)]), rnd.choice("xyz")) for _ in range(500)],
                        columns=["node", "f0", "f1", "y"])
    calls, split = [], subtrees._best
    monkeypatch.setattr(subtrees, "_best", lambda *a: calls.append(1) or split(*a))

    def grown(limit):
        monkeypatch.setattr(subtrees, "CLASSES", limit)
        out = pd.concat(subtrees.grower(["f0", "f1"], [False, True], "y", score, 7)([rows[:200], rows[200:]]))
        return sorted((r.node, r.depth, r.col or "", r.vnum or 0, r.vstr or "", r.is_leaf, r["keys"], r.counts, r.n) for _, r in out.iterrows())

    at_once = grown(32)
    assert not calls and len(at_once) > 100
    assert at_once == grown(0) and len(calls) > 50
