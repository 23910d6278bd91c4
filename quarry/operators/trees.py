"""Decision and regression trees (inventory T1-T7, A11-A14, P9).

The tree is a node table ``(node, depth, col, vnum, vstr, is_leaf, results, n,
mean, var)``.  A node is named by its path from the root, ``r``, then ``T`` or
``F`` for each step to a true or false child, so the depth has no limit.
Building is level-wise: one pass per level scores every candidate split of
every open node at once and moves each row to its child, so the number of Spark
jobs grows with the depth, not with the number of nodes. A node of at most
``local_rows`` rows is grown to its end in one task (``subtrees``): the levels
that cost jobs are those of the large nodes.

Candidate splits are all values of every feature in the node, as in the
reference: numeric features split on ``>=`` (true side), others on ``=``.
All features of a row are stacked and counted in one aggregation.  Impurities
come from sums over classes (of ``c log c`` or ``c^2``) that change with each
value only by the classes it holds, so no class list is needed and both sides
of a numeric split are running sums.  These are taken over ranges of values, a
range a task, with one number per range added, so a node that holds all rows is
not one task.  Ties between gains equal to 9 decimals go to the lower feature
index, then the lower value.

A leaf keeps its class counts, or for a variance tree the mean and variance of
its targets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from quarry.operators import subtrees
from quarry.operators.levels import Levels
from quarry.session import cut_lineage

TIE_DIGITS = 9
NOISE = 1e-12           # a gain below this is rounding of a zero gain
ROOT = "r"
PART_ROWS = 20_000      # training rows of a node whose part of the tree is one task's
LOT_ROWS = 200_000      # rows of nodes that are grown together in a task
CANDIDATE = ["node", "col_idx", "vnum", "vstr"]


def _is_num(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NumericType)


def _stacked(rows: DataFrame, features: list[str], keep: str) -> DataFrame:
    """One row per (row, feature) with a value: node, col_idx, vnum or vstr."""
    cells = []
    for i, c in enumerate(features):
        num = _is_num(rows, c)
        cells.append(F.struct(F.lit(i).alias("col_idx"),
                              (F.col(c) if num else F.lit(None)).cast("double").alias("vnum"),
                              (F.lit(None) if num else F.col(c)).cast("string").alias("vstr")))
    out = rows.select("node", keep, F.explode(F.array(*cells)).alias("x")).select("node", keep, "x.*")
    return out.where(F.col("vnum").isNotNull() | F.col("vstr").isNotNull())


def running_sums(df: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """``df`` with ``run_<s>``: per key the sum of s over all rows with the
    same or a larger ``order``.  (keys, order) must be unique.

    Rows are dealt into ranges of (keys, order); each range is summed by
    itself, and what lies before it is a sum over ranges."""
    dealt = df.repartitionByRange(*keys, F.desc(order)).withColumn("_b", F.spark_partition_id())
    placed = cut_lineage(dealt)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = (placed.groupBy(*keys, "_b").agg(*[F.sum(s).alias(s) for s in sums])
            .select(*keys, "_b", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_base_{s}") for s in sums]))
    within = Window.partitionBy(*keys, "_b").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    return (placed.join(base, [*keys, "_b"])
            .select(*df.columns, *[(F.sum(s).over(within) + F.col(f"_base_{s}")).alias(f"run_{s}") for s in sums]))


def _term(score: str, x: Column) -> Column:
    """What a class of x rows adds: x log2 x (entropy) or x^2 (gini)."""
    x = x.cast("double")
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0)) if score == "entropy" else x * x


def _impurity(score: str, n: Column, s: Column) -> Column:
    """Impurity of n rows whose classes' terms sum to s."""
    n = n.cast("double")
    return F.when(n > 0, F.log2(n) - s / n if score == "entropy" else F.lit(1.0) - s / (n * n)).otherwise(F.lit(0.0))


def _class_candidates(rows: DataFrame, features: list[str], label: str, score: str) -> DataFrame:
    """(candidate, n1, h1, n, h, h2): sizes and impurities of both sides."""
    rows = rows.withColumn("k", F.col(label).cast("string"))
    totals = cut_lineage(rows.groupBy("node", "k").agg(F.count(F.lit(1)).alias("t")))
    nodes = totals.groupBy("node").agg(F.sum("t").alias("n"), F.sum(_term(score, F.col("t"))).alias("ft"))
    cnt = _stacked(rows, features, "k").groupBy(*CANDIDATE, "k").agg(F.count(F.lit(1)).alias("c"))
    cnt = cut_lineage(_with_totals(cnt, totals))
    c, t = F.col("c"), F.col("t")
    eq = (cnt.where("vstr IS NOT NULL").groupBy(*CANDIDATE)
          .agg(F.sum("c").alias("n1"), F.sum(_term(score, c)).alias("s1"), F.sum(_term(score, t - c) - _term(score, t)).alias("d2")))
    per_class = running_sums(cnt.where("vnum IS NOT NULL").drop("vstr"), ["node", "col_idx", "k"], "vnum", ["c"])
    run = F.col("run_c")
    steps = (per_class.groupBy("node", "col_idx", "vnum")
             .agg(F.sum("c").alias("n1"), F.sum(_term(score, run) - _term(score, run - c)).alias("s1"),
                  F.sum(_term(score, t - run) - _term(score, t - run + c)).alias("d2")))
    ge = running_sums(steps, ["node", "col_idx"], "vnum", ["n1", "s1", "d2"]).select(
        "node", "col_idx", "vnum", F.lit(None).cast("string").alias("vstr"), F.col("run_n1").alias("n1"),
        F.col("run_s1").alias("s1"), F.col("run_d2").alias("d2"))
    cand = eq.unionByName(ge).join(nodes, "node")
    n, n1 = F.col("n"), F.col("n1")
    return cand.select(*CANDIDATE, "n", "n1", _impurity(score, n, F.col("ft")).alias("h"), _impurity(score, n1, F.col("s1")).alias("h1"),
                       _impurity(score, n - n1, F.col("ft") + F.col("d2")).alias("h2"))


def _with_totals(cnt: DataFrame, totals: DataFrame) -> DataFrame:
    """Class counts with the class's total in the node; a null label is a
    class like any other."""
    key = lambda: F.coalesce(F.concat(F.lit("="), F.col("k")), F.lit(""))
    return (cnt.withColumn("k", key()).join(totals.withColumn("k", key()), ["node", "k"]))


def _moment_candidates(rows: DataFrame, features: list[str], label: str) -> DataFrame:
    """The same for variance: counts, sums and sums of squares of the target."""
    rows = rows.withColumn("y", F.col(label).cast("double"))
    y = F.col("y")
    moments = [F.count(F.lit(1)).alias("n1"), F.sum(y).alias("s1"), F.sum(y * y).alias("q1")]
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
    cnt = cut_lineage(_stacked(rows, features, "y").groupBy(*CANDIDATE).agg(*moments))
    ge = running_sums(cnt.where("vnum IS NOT NULL").drop("vstr"), ["node", "col_idx"], "vnum", ["n1", "s1", "q1"])
    ge = ge.select("node", "col_idx", "vnum", F.lit(None).cast("string").alias("vstr"),
                   *[F.col(f"run_{c}").alias(c) for c in ("n1", "s1", "q1")])
    cand = cnt.where("vstr IS NOT NULL").unionByName(ge).join(nodes, "node")

    def var(n: Column, s: Column, q: Column) -> Column:
        return F.when(n > 0, F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))).otherwise(F.lit(0.0))

    n, s, q, n1, s1, q1 = (F.col(c) for c in ("n", "s", "q", "n1", "s1", "q1"))
    return cand.select(*CANDIDATE, "n", "n1", var(n, s, q).alias("h"), var(n1, s1, q1).alias("h1"),
                       var(n - n1, s - s1, q - q1).alias("h2"))


def best_splits(rows: DataFrame, features: list[str], label: str, score: str = "entropy") -> DataFrame:
    """The best split of every node of ``rows`` (columns node + features
    + label).  Output (node, col_idx, col, vnum, vstr, gain, n); only splits
    with a gain and both sides non-empty."""
    if score == "variance":
        cand = _moment_candidates(rows, features, label)
    else:
        cand = _class_candidates(rows, features, label, score)
    p = F.col("n1") / F.col("n")
    gain = F.col("h") - p * F.col("h1") - (F.lit(1.0) - p) * F.col("h2")
    ok = (cand.withColumn("gain", gain)
          .where((F.col("gain") > NOISE) & (F.col("n1") > 0) & (F.col("n1") < F.col("n"))))
    # the best of a node by an aggregate (partial first), not by a sort of its candidates
    rank = F.struct((-F.round("gain", TIE_DIGITS)).alias("g"), "col_idx", F.coalesce("vnum", F.lit(0.0)).alias("v"),
                    F.coalesce("vstr", F.lit("")).alias("s"))
    best = ok.groupBy("node").agg(F.min_by(F.struct("col_idx", "vnum", "vstr", "gain", "n"), rank).alias("b"))
    names = F.array(*[F.lit(c) for c in features])
    return best.select("node", "b.col_idx", F.get(names, F.col("b.col_idx")).alias("col"), "b.vnum", "b.vstr", "b.gain", "b.n")


def root_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The training rows at the root, materialised once so that the node is
    data, not a literal the optimiser could fold into a keyless join."""
    return cut_lineage(df.select(*columns).withColumn("node", F.lit(ROOT)))


def _leaves(rows: DataFrame, label: str, score: str, depth: int | Column) -> DataFrame:
    """Leaf rows of the node table for the nodes of ``rows``."""
    head = ["node", F.lit(depth).alias("depth"), F.lit(None).cast("string").alias("col"), F.lit(None).cast("double").alias("vnum"),
            F.lit(None).cast("string").alias("vstr"), F.lit(True).alias("is_leaf")]
    if score == "variance":
        y = F.col(label).cast("double")
        c = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var"))
        return c.select(*head, F.lit(None).cast("map<string,bigint>").alias("results"), "n", "mean", "var")
    c = rows.groupBy("node", F.coalesce(F.col(label).cast("string"), F.lit("null")).alias("k")).agg(F.count(F.lit(1)).alias("v"))
    c = c.groupBy("node").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("results"),
                              F.sum("v").alias("n"))
    return c.select(*head, "results", "n", F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("var"))


def _test_of(features: list[str], num: dict) -> Column:
    """The node's split evaluated on a row (P9); null if the value is."""
    test = F.lit(None).cast("boolean")
    for i, c in enumerate(features):
        here = F.col(c).cast("double") >= F.col("vnum") if num[c] else F.col(c).cast("string") == F.col("vstr")
        test = F.when(F.col("col_idx") == i, here).otherwise(test)
    return test


def _child(side: Column) -> Column:
    return F.concat(F.col("node"), F.when(F.coalesce(side, F.lit(False)), "T").otherwise("F"))


def _subtrees(rows: DataFrame, features: list[str], label: str, score: str, max_depth: int | None) -> DataFrame:
    """The node table of every node of ``rows`` and all below. Nodes are dealt
    out over tasks, each of about ``LOT_ROWS`` rows or one node."""
    num = [_is_num(rows, c) for c in features]
    typed = rows.select("node", *[F.col(c).cast("double" if n else "string").alias(f"f{i}") for i, (c, n) in enumerate(zip(features, num, strict=True))],
                        F.col(label).cast("double" if score == "variance" else "string").alias("y"))
    grow = subtrees.grower([f"f{i}" for i in range(len(features))], num, "y", score, max_depth)
    lots = max(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // LOT_ROWS))     # by number, as a row costs far more than its bytes
    col = F.get(F.array(*[F.lit(c) for c in features]), F.substring("col", 2, 10).cast("int"))
    return (typed.repartition(lots, "node").mapInPandas(grow, subtrees.SCHEMA)
            .select("node", "depth", col.alias("col"), "vnum", "vstr", "is_leaf", F.map_from_arrays("keys", "counts").alias("results"), "n", "mean", "var"))


def build_tree(df: DataFrame, features: list[str], label: str, score: str = "entropy",
               max_depth: int | None = None, local_rows: int = 0) -> DataFrame:
    """Grow the tree until no split has a gain, or to ``max_depth``
    if the caller sets one.  Q25 fixed: every level uses ``score``.
    ``local_rows``: the most rows of a node that one task splits to its end;
    with few classes a task grows more at once (``levels.NODE_ROWS``)."""
    num = {c: _is_num(df, c) for c in features}
    rows = root_rows(df, [*features, label])
    parts, depth = [], 0
    if local_rows and rows.count() > local_rows:
        levels = Levels(rows, features, list(num.values()), label, score)
        if levels.n <= levels.node_rows:
            return cut_lineage(_subtrees(rows, features, label, score, max_depth))
        if levels.usable:
            return _with_levels(levels, rows, label, max_depth, max(local_rows, levels.node_rows))
    while True:
        if local_rows:
            small = cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= local_rows).select("node"))
            if not small.isEmpty():
                parts.append(cut_lineage(_subtrees(rows.join(small, "node"), features, label, score, max_depth)))
                rows = cut_lineage(rows.join(small, "node", "left_anti").select(rows.columns))
            if rows.isEmpty() and parts:
                break
        splits = None
        if max_depth is None or depth < max_depth:
            splits = cut_lineage(best_splits(rows, features, label, score))
        if splits is None or splits.isEmpty():
            parts.append(_leaves(rows, label, score, depth))
            break
        leaves = _leaves(rows.join(splits.select("node"), "node", "left_anti"), label, score, depth)
        inner = splits.select("node", F.lit(depth).alias("depth"), "col", "vnum", "vstr", F.lit(False).alias("is_leaf"),
                              F.lit(None).cast("map<string,bigint>").alias("results"), "n",
                              F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("var"))
        parts.append(cut_lineage(leaves.unionByName(inner)))
        moved = rows.join(splits.select("node", "col_idx", "vnum", "vstr"), "node")
        rows = cut_lineage(moved.select(*features, label, _child(_test_of(features, num)).alias("node")))
        depth += 1
    return cut_lineage(reduce(lambda a, b: a.unionByName(b), parts))


def _walk_udf(nodes: pd.DataFrame, num: list[bool]) -> Callable[..., Column]:
    walk = subtrees.walker(nodes, num, ROOT)
    return F.pandas_udf(lambda x: walk(*[x[c] for c in x.columns]), "string")


def _values(df: DataFrame, features: list[str], num: list[bool]) -> list[Column]:
    """Features as tests see them: numbers, of which NaN is the largest, or text."""
    x = lambda c: F.col(c).cast("double")
    return [(F.when(F.isnan(x(c)), F.lit(float("inf"))).otherwise(x(c)) if n else F.col(c).cast("string")).alias(f"f{i}")
            for i, (c, n) in enumerate(zip(features, num, strict=True))]


def _with_levels(levels: Levels, rows: DataFrame, label: str, max_depth: int | None, local_rows: int) -> DataFrame:
    """The whole node table: large nodes by ``levels``, the rest in tasks."""
    features, num, score = levels.features, levels.num, levels.score
    inner, ended = levels.grown(ROOT, max_depth, local_rows)
    top = pd.DataFrame(inner, columns=["node", "depth", "col_idx", "vnum", "vstr", "n"]).astype({"vstr": object})
    walk = _walk_udf(top, num)
    placed = cut_lineage(rows.select(*features, label, walk(F.struct(*levels.kinds)).alias("node")))
    spark = rows.sparkSession
    table = spark.createDataFrame([(n, d, features[i], v, t, k) for n, d, i, v, t, k in inner],
                                  "node string, depth int, col string, vnum double, vstr string, n long")
    none = lambda kind: F.lit(None).cast(kind)
    table = table.select("node", "depth", "col", "vnum", "vstr", F.lit(False).alias("is_leaf"), none("map<string,bigint>").alias("results"),
                         "n", none("double").alias("mean"), none("double").alias("var"))
    ends = F.col("node").isin(ended) if ended else F.lit(False)
    parts = [table, _subtrees(placed.where(~ends), features, label, score, max_depth)]
    if ended:
        parts.append(_leaves(placed.where(ends), label, score, F.length("node") - 1))
    return cut_lineage(reduce(lambda a, b: a.unionByName(b), parts))


def _inner(tree: DataFrame, features: list[str]) -> DataFrame:
    idx = F.coalesce(*[F.when(F.col("col") == c, F.lit(i)) for i, c in enumerate(features)])
    return tree.where(~F.col("is_leaf")).select("node", idx.alias("col_idx"), "vnum", "vstr")


def _routed(tree: DataFrame, df: DataFrame, features: list[str], key: str, both: bool) -> DataFrame:
    """(key, node): the leaf, or with ``both`` every leaf that missing values
    leave open, of each row."""
    num = {c: _is_num(df, c) for c in features}
    inner = _inner(tree, features)
    depth = tree.agg(F.max("depth")).first()[0] or 0
    cur = cut_lineage(df.select(key, *features, F.lit(ROOT).alias("node")))
    for d in range(depth):
        test = _test_of(features, num)
        sides = F.when(test.isNull() & F.lit(both), F.array(F.lit("T"), F.lit("F"))).otherwise(
            F.array(F.when(F.coalesce(test, F.lit(False)), "T").otherwise("F")))
        sides = F.when(F.col("col_idx").isNull(), F.array(F.lit(""))).otherwise(sides)
        cur = (cur.join(inner, "node", "left")
               .select(key, *features, "node", F.explode(sides).alias("side"))
               .select(key, *features, F.concat("node", "side").alias("node")))
        if d % 8 == 7:
            cur = cut_lineage(cur)
    return cur.select(key, "node")


def _top(tree: DataFrame, part_rows: int) -> DataFrame:
    """The internal nodes of more than ``part_rows`` training rows: at most
    (rows / part_rows) a level, whatever the tree's size."""
    return tree.where(~F.col("is_leaf") & (F.col("n") > part_rows))


def _walked(tree: DataFrame, df: DataFrame, features: list[str], key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, node): the leaf of each row. Rows go down the large nodes in one
    pass, then meet the part of the tree below the node that they reached,
    ``part_rows`` rows at a time."""
    num = [_is_num(df, c) for c in features]
    idx = F.coalesce(*[F.when(F.col("col") == c, F.lit(i)) for i, c in enumerate(features)])
    picked = ["node", idx.alias("col_idx"), "vnum", "vstr"]
    top = _top(tree, part_rows).select(*picked).toPandas().astype({"vstr": object})
    x = df.select(key, *_values(df, features, num))
    at = _walk_udf(top, num)(F.struct(*[f"f{i}" for i in range(len(features))]))
    rows = cut_lineage(x.withColumn("at", at))
    lower = _below(tree.where(~F.col("is_leaf")), top["node"]).select(*picked, "at")
    parts = rows.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(parts), "at").withColumn("part", F.pmod(F.xxhash64(key, F.col("f0")), F.col("parts")).cast("int")).drop("parts")
    copies = lower.join(F.broadcast(parts), "at").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    kind = df.schema[key].dataType.simpleString()

    def leaf(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"key": [], "node": []})
        walk = subtrees.walker(nodes, num, rows["at"].iloc[0])
        return pd.DataFrame({"key": rows["key"], "node": walk(*[rows[f"f{i}"] for i in range(len(num))]).to_numpy()})

    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    dealt = dealt.withColumnRenamed(key, "key").repartition(tasks, "at", "part")
    out = dealt.groupBy("at", "part").cogroup(copies.repartition(tasks, "at", "part").groupBy("at", "part")).applyInPandas(leaf, f"key {kind}, node string")
    return out.withColumnRenamed("key", key)


def _below(nodes: DataFrame, top: Iterable[str]) -> DataFrame:
    """``nodes`` without those named by ``top``, which has every node above
    its own, with ``at``: the first node outside of it on the way to them."""
    inside = set(top)

    def first(node: pd.Series) -> pd.Series:
        def one(n: str) -> str:
            lo, hi = 0, len(n)
            while lo < hi:                                  # the longest prefix inside
                mid = (lo + hi + 1) // 2
                lo, hi = (mid, hi) if n[:mid] in inside else (lo, mid - 1)
            return n[:lo + 1] if lo else n[:1]
        return node.map(lambda n: "" if n in inside else one(n))

    return nodes.withColumn("at", F.pandas_udf(first, "string")("node")).where("at <> ''")


def classify(tree: DataFrame, df: DataFrame, features: list[str], key: str) -> DataFrame:
    """Route every row from the root to its leaf (``_walked``); a missing
    value goes to the false side.  Output (key, node, results, mean)."""
    leaves = tree.where(F.col("is_leaf")).select("node", "results", "mean")
    return _walked(tree, df, features, key).join(leaves, "node").select(key, "node", "results", "mean")


def classify_missing(tree: DataFrame, df: DataFrame, features: list[str], key: str) -> DataFrame:
    """T4: where the split value is missing both branches are followed and
    their class counts merged, each weighted by its share of the two branches'
    counts; counts of a class in both are added (Q26).  ``key`` must be unique.
    Output (key, class, weight)."""
    leaves = tree.where(F.col("is_leaf")).select("node", F.explode("results").alias("class", "weight"))
    # the weights follow from the leaves reached: each set of them is merged once, whatever its number of rows
    reached = cut_lineage(_routed(tree, df, features, key, both=True).groupBy(key).agg(F.array_sort(F.collect_list("node")).alias("nodes")))
    cur = reached.select("nodes").distinct().select("nodes", F.explode("nodes").alias("node")).join(leaves, "node").select(
        "nodes", "node", "class", F.col("weight").cast("double").alias("weight"))
    depth = tree.agg(F.max("depth")).first()[0] or 0
    for d in range(depth, 0, -1):
        here = F.length("node") == d + 1
        parent = F.when(here, F.substring(F.col("node"), 1, d)).otherwise(F.col("node"))
        branch = Window.partitionBy("nodes", "node")
        pair = Window.partitionBy("nodes", parent)
        # one branch alone keeps its counts: its share is one
        share = F.sum("weight").over(branch) / F.sum("weight").over(pair)
        weight = F.when(here, F.col("weight") * share).otherwise(F.col("weight"))
        cur = (cur.select("nodes", parent.alias("p"), "class", weight.alias("weight"))
               .groupBy("nodes", F.col("p").alias("node"), "class").agg(F.sum("weight").alias("weight")))
        if d % 4 == 0:
            cur = cut_lineage(cur)
    return reached.join(cut_lineage(cur.select("nodes", "class", "weight")), "nodes").select(key, "class", "weight")


def tree_shape(tree: DataFrame) -> DataFrame:
    """Width (number of leaves) and depth (levels below the root)."""
    return tree.agg(F.count_if(F.col("is_leaf")).alias("width"), F.max("depth").alias("depth"))


def tree_listing(tree: DataFrame) -> DataFrame:
    """Pre-order listing by the path (true branch first); text is
    'col:value?' or the leaf results."""
    leaf = F.coalesce(F.to_json("results"), F.to_json(F.struct("n", "mean", "var")))
    text = F.when(F.col("is_leaf"), leaf).otherwise(
        F.concat(F.col("col"), F.lit(":"), F.coalesce(F.col("vstr"), F.col("vnum").cast("string")), F.lit("?")))
    path = F.translate(F.substring(F.col("node"), 2, 1 << 30), "TF", "01")
    return tree.select("node", "depth", path.alias("path"), text.alias("text")).orderBy("path")


def prune(tree: DataFrame, min_gain: float, parity: bool = False, part_rows: int = PART_ROWS) -> DataFrame:
    """T5: bottom-up, merge two leaf children whose entropy reduction is
    below ``min_gain``.  Default gain H(all) - (H(t) + H(f)) / 2; ``parity``
    uses the reference's H(all) - (H(t) + H(f) / 2) (Q27).

    Nodes below the large ones are pruned part by part in tasks, then the large
    ones with what is left of the parts' own roots."""
    cur = cut_lineage(tree)
    top = [r["node"] for r in _top(cur, part_rows).select("node").collect()]
    merge = subtrees.pruner(min_gain, parity)
    schema = "node string, keys array<string>, counts array<long>"
    seen = ["node", "is_leaf", F.map_keys("results").alias("keys"), F.map_values("results").alias("counts")]
    tasks = 4 * tree.sparkSession.sparkContext.defaultParallelism
    parts = _below(cur, top)
    low = parts.select(*seen, "at").repartition(tasks, "at").groupBy("at").applyInPandas(lambda pdf: merge(pdf), schema)
    cur = cut_lineage(_merged(cur, low))
    if top:
        own = _below(cur, top).where("node = at").select("node")
        high = cur.join(own.unionByName(_top(cur, part_rows).select("node")), "node", "left_semi").select(*seen)
        cur = cut_lineage(_merged(cur, high.groupBy(F.lit(0).alias("all")).applyInPandas(lambda pdf: merge(pdf), schema)))
    return cur


def _merged(tree: DataFrame, changes: DataFrame) -> DataFrame:
    """``tree`` after ``changes``: nodes without keys go, others become leaves."""
    changes = changes.select("node", F.map_from_arrays("keys", "counts").alias("mres"), F.lit(True).alias("hit"))
    now = F.col("mres").isNotNull()
    return tree.join(changes, "node", "left").where(now | F.col("hit").isNull()).select(
        "node", "depth", *[F.when(~now, F.col(c)).alias(c) for c in ("col", "vnum", "vstr")],
        (F.col("is_leaf") | now).alias("is_leaf"), F.coalesce("mres", "results").alias("results"), "n", "mean", "var")
