"""Registered queries: decision and regression trees over orders.

Label: order status; features: priority (text), order year and month and price
(numbers; the price is continuous).  The regression tree predicts the price.
Some queries grow three levels, a parameter of theirs, so that SQL can state the
result level by level; the ``whole`` queries grow their tree until no split has
a gain, have no SQL, and are tested against a recursive brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import trees as TR
from quarry.plans.registry import register
from quarry.sources.tables import Tables

FEATURES = ["o_orderpriority", "o_year", "o_month", "o_totalprice"]
PRICE_FEATURES = FEATURES[:3]
DEPTH = 3
LOCAL_ROWS = 20_000
MIN_GAIN = 0.03


def _orders(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("o_year"),
                    F.month("o_orderdate").alias("o_month"), "o_orderstatus", "o_totalprice")


def _tree(spark, sf, score="entropy"):
    return TR.build_tree(_orders(spark, sf), FEATURES, "o_orderstatus", score, DEPTH)


def _price_tree(spark, sf):
    return TR.build_tree(_orders(spark, sf), PRICE_FEATURES, "o_totalprice", "variance", DEPTH)


def _table(tree):
    """The node table with results as JSON text."""
    return tree.select("node", "depth", "col", "vnum", "vstr", "is_leaf", F.to_json("results").alias("results"), "n",
                       F.round("mean", 4).alias("mean"), F.round("var", 2).alias("var"))


CLASSES = "FOP"
_CLASS_COUNTS = ", ".join(f"count(*) FILTER (WHERE y = '{k}') AS c_{k}" for k in CLASSES)


def _entropy_sql(cells: list[str], n: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} > 0 THEN -({c}) / ({n}) * log2(({c}) / ({n})) ELSE 0.0 END" for c in cells) + ")"


def _gini_sql(cells: list[str], n: str) -> str:
    return "(1.0 - " + " - ".join(f"(({c}) / ({n})) * (({c}) / ({n}))" for c in cells) + ")"


def _variance_sql(s: str, q: str, n: str) -> str:
    return f"greatest(({q}) / ({n}) - (({s}) / ({n})) * (({s}) / ({n})), 0.0)"


def _levels_sql(kind: str, depth: int) -> str:
    """Rows d<i> and splits s<i> of each level."""
    reg = kind == "variance"
    stats = ["n1", "s", "q"] if reg else [f"c_{k}" for k in CLASSES]
    count = "count(*) AS n1, sum(y) AS s, sum(y * y) AS q" if reg else _CLASS_COUNTS
    y = "o_totalprice" if reg else "o_orderstatus"
    n_features = len(PRICE_FEATURES if reg else FEATURES)
    out = [f"""d0 AS (SELECT o_orderkey, o_orderpriority AS f0, year(o_orderdate) AS f1, month(o_orderdate) AS f2,
  o_totalprice AS f3, {y} AS y, 'r' AS node FROM orders)"""]
    for i in range(depth + 1):
        parts = []
        for j in range(n_features):
            g = f"SELECT node, f{j} AS v, {count} FROM d{i} WHERE f{j} IS NOT NULL GROUP BY ALL"
            if j == 0:
                parts.append(f"SELECT node, 0 AS col_idx, NULL::DOUBLE AS vnum, v::VARCHAR AS vstr, {', '.join(stats)} FROM ({g})")
            else:
                run = ", ".join(f"sum({s}) OVER (PARTITION BY node ORDER BY v DESC) AS {s}" for s in stats)
                parts.append(f"SELECT node, {j}, v::DOUBLE, NULL, {run} FROM ({g})")
        totals = ", ".join(f"t.{s} AS t_{s}" for s in stats)
        if reg:
            n, n1 = "t_n1", "n1"
            h, h1, h2 = _variance_sql("t_s", "t_q", n), _variance_sql("s", "q", n1), _variance_sql("t_s - s", "t_q - q", f"{n} - {n1}")
        else:
            imp = _entropy_sql if kind == "entropy" else _gini_sql
            n, n1 = "(" + " + ".join(f"t_{s}" for s in stats) + ")", "(" + " + ".join(stats) + ")"
            h, h1, h2 = imp([f"t_{s}" for s in stats], n), imp(stats, n1), imp([f"t_{s} - {s}" for s in stats], f"{n} - {n1}")
        names = " ".join(f"WHEN {j} THEN '{c}'" for j, c in enumerate(FEATURES))
        out.append(f"""k{i} AS ({' UNION ALL '.join(parts)}),
t{i} AS (SELECT node, {count} FROM d{i} GROUP BY node),
g{i} AS (SELECT k.node, col_idx, vnum, vstr, {n} AS n, {n1} AS m, {', '.join(f'k.{s}' for s in stats)}, {totals}
  FROM (SELECT k{i}.* FROM k{i}) k JOIN t{i} t USING (node))""".replace(f"{n} AS n, {n1} AS m, ", ""))
        out.append(f"""s{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, col_idx, vnum, vstr) AS r
  FROM (SELECT node, col_idx, CASE col_idx {names} END AS col, vnum, vstr, {n} AS n,
               CASE WHEN {n1} > 0 AND {n1} < {n} THEN {h} - {n1} / {n} * {h1} - (1.0 - {n1} / {n}) * {h2} END AS gain FROM g{i})
  WHERE gain > 1e-12) WHERE r = 1 AND {i} < {depth})""")
        test = " OR ".join(["col_idx = 0 AND f0 = vstr"] + [f"col_idx = {j} AND f{j} >= vnum" for j in range(1, n_features)])
        out.append(f"""d{i + 1} AS (SELECT o_orderkey, f0, f1, f2, f3, y, d.node || CASE WHEN {test} THEN 'T' ELSE 'F' END AS node
  FROM d{i} d JOIN s{i} USING (node))""")
    return ",\n".join(out)


def _tree_sql(kind: str, depth: int = DEPTH) -> str:
    """CTEs ending in ``tree``, the node table."""
    reg = kind == "variance"
    nodes = []
    for i in range(depth + 1):
        if reg:
            leaf = f"""SELECT node, NULL::VARCHAR AS results, count(*) AS n, avg(y) AS mean, var_pop(y) AS var FROM d{i} GROUP BY node"""
        else:
            leaf = f"""SELECT node, '{{' || string_agg('"' || y || '":' || c, ',' ORDER BY y) || '}}' AS results, sum(c)::BIGINT AS n,
  NULL::DOUBLE AS mean, NULL::DOUBLE AS var FROM (SELECT node, y, count(*) AS c FROM d{i} GROUP BY ALL) GROUP BY node"""
        nodes.append(f"""SELECT node, {i} AS depth, NULL::VARCHAR AS col, NULL::DOUBLE AS vnum, NULL::VARCHAR AS vstr, true AS is_leaf, results, n, mean, var
  FROM ({leaf}) WHERE node NOT IN (SELECT node FROM s{i})
  UNION ALL SELECT node, {i}, col, vnum, vstr, false, NULL, n::BIGINT, NULL, NULL FROM s{i}""")
    return f"WITH {_levels_sql(kind, depth)},\ntree AS ({' UNION ALL '.join(nodes)})"


_SELECT_TREE = "SELECT node, depth, col, vnum, vstr, is_leaf, results, n, round(mean, 4) AS mean, round(var, 2) AS var FROM {}"


@register("t1_best_split", sql=_tree_sql("entropy", 1) + " SELECT col_idx, col, vnum, vstr, round(gain, 9) AS gain, n FROM s0")
def t1(spark, sf):
    """Best first split of the order-status tree (entropy gain)."""
    o = TR.root_rows(_orders(spark, sf), [*FEATURES, "o_orderstatus"])
    return TR.best_splits(o, FEATURES, "o_orderstatus").select("col_idx", "col", "vnum", "vstr", F.round("gain", 9).alias("gain"), "n")


@register("t1_best_split_gini", sql=_tree_sql("gini", 1) + " SELECT col_idx, col, vnum, vstr, round(gain, 9) AS gain, n FROM s0")
def t1g(spark, sf):
    """Best first split by Gini impurity."""
    o = TR.root_rows(_orders(spark, sf), [*FEATURES, "o_orderstatus"])
    return TR.best_splits(o, FEATURES, "o_orderstatus", "gini").select("col_idx", "col", "vnum", "vstr", F.round("gain", 9).alias("gain"), "n")


@register("t2_build_tree", sql=f"{_tree_sql('entropy')} {_SELECT_TREE.format('tree')}")
def t2(spark, sf):
    """The order-status tree."""
    return _table(_tree(spark, sf))


_ALL_ROWS = " UNION ALL ".join(f"SELECT o_orderkey, node FROM d{i} WHERE node NOT IN (SELECT node FROM s{i})" for i in range(DEPTH + 1))


@register("t3_classify", sql=f"""{_tree_sql('entropy')}
SELECT o_orderkey, node, results FROM ({_ALL_ROWS}) JOIN tree USING (node)""")
def t3(spark, sf):
    """Every order routed to its leaf of the order-status tree."""
    out = TR.classify(_tree(spark, sf), _orders(spark, sf), FEATURES, "o_orderkey")
    return out.select("o_orderkey", "node", F.to_json("results").alias("results"))


def _missing_sql() -> str:
    """Rows with prices and years missing by order key, followed down both
    branches; then merged from the deepest level up."""
    out = [_tree_sql("entropy"), """m AS (SELECT o_orderkey, f0, CASE WHEN o_orderkey % 5 <> 0 THEN f1 END AS f1, f2,
  CASE WHEN o_orderkey % 3 <> 0 THEN f3 END AS f3 FROM d0),
inner_nodes AS (SELECT node, list_position(['o_orderpriority', 'o_year', 'o_month', 'o_totalprice'], col) - 1 AS j, vnum, vstr FROM tree WHERE NOT is_leaf),
e0 AS (SELECT m.*, 'r' AS node FROM m)"""]
    for i in range(DEPTH):
        test = "CASE j WHEN 0 THEN f0 = vstr WHEN 1 THEN f1 >= vnum WHEN 2 THEN f2 >= vnum ELSE f3 >= vnum END"
        out.append(f"""e{i + 1} AS (SELECT o_orderkey, f0, f1, f2, f3, e.node || side AS node FROM (
  SELECT e.*, unnest(CASE WHEN j IS NULL THEN [''] WHEN {test} IS NULL THEN ['T', 'F'] WHEN {test} THEN ['T'] ELSE ['F'] END) AS side
  FROM e{i} e LEFT JOIN inner_nodes n ON n.node = e.node) e)""")
    counts = " UNION ALL ".join(f"SELECT node, y AS class, count(*)::DOUBLE AS w FROM d{i} WHERE node NOT IN (SELECT node FROM s{i}) GROUP BY ALL" for i in range(DEPTH + 1))
    out.append(f"leaf AS ({counts}),\nw{DEPTH} AS (SELECT o_orderkey, node, class, w FROM e{DEPTH} JOIN leaf USING (node))")
    for d in range(DEPTH, 0, -1):
        out.append(f"""x{d} AS (SELECT o_orderkey, class, CASE WHEN length(node) = {d + 1} THEN substr(node, 1, {d}) ELSE node END AS p,
  CASE WHEN length(node) = {d + 1} THEN w * sum(w) OVER (PARTITION BY o_orderkey, node)
    / sum(w) OVER (PARTITION BY o_orderkey, CASE WHEN length(node) = {d + 1} THEN substr(node, 1, {d}) ELSE node END) ELSE w END AS w FROM w{d}),
w{d - 1} AS (SELECT o_orderkey, p AS node, class, sum(w) AS w FROM x{d} GROUP BY ALL)""")
    return ",\n".join(out) + " SELECT o_orderkey, class, w AS weight FROM w0"


@register("t4_classify_missing", sql=_missing_sql())
def t4(spark, sf):
    """Class weights of every order, the price of each third and the year of
    each fifth order taken as unknown."""
    o = _orders(spark, sf)
    known = o.withColumns({"o_totalprice": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")),
                           "o_year": F.when(F.col("o_orderkey") % 5 != 0, F.col("o_year"))})
    return TR.classify_missing(_tree(spark, sf), known, FEATURES, "o_orderkey")


def _prune_sql() -> str:
    counts = " UNION ALL ".join(f"SELECT node, y, count(*) AS c FROM d{i} WHERE node NOT IN (SELECT node FROM s{i}) GROUP BY ALL" for i in range(DEPTH + 1))
    out = [_tree_sql("entropy"), f"z{DEPTH} AS ({counts})"]
    ent = "sum(-c / s * log2(c / s))"
    for d in range(DEPTH - 1, -1, -1):
        out.append(f"""a{d} AS (SELECT *, substr(node, 1, {d + 1}) AS p, sum(c) OVER (PARTITION BY node) AS s FROM z{d + 1} WHERE length(node) = {d + 2}),
b{d} AS (SELECT p, node, {ent} AS h FROM a{d} GROUP BY ALL),
u{d} AS (SELECT p, y, c, sum(c) OVER (PARTITION BY p) AS s FROM (SELECT p, y, sum(c) AS c FROM a{d} GROUP BY ALL)),
v{d} AS (SELECT p FROM (SELECT p, {ent} AS h FROM u{d} GROUP BY p) JOIN (SELECT p, avg(h) AS m FROM b{d} GROUP BY p HAVING count(*) = 2) USING (p) WHERE h - m < {MIN_GAIN}),
z{d} AS (SELECT node, y, c FROM z{d + 1} WHERE length(node) <> {d + 2} OR substr(node, 1, {d + 1}) NOT IN (SELECT p FROM v{d})
  UNION ALL SELECT p, y, c FROM u{d} WHERE p IN (SELECT p FROM v{d}))""")
    return ",\n".join(out) + """,
leaf AS (SELECT node, '{' || string_agg('"' || y || '":' || c, ',' ORDER BY y) || '}' AS results FROM z0 GROUP BY node)
SELECT tree.node, depth, CASE WHEN leaf.node IS NULL THEN col END AS col, CASE WHEN leaf.node IS NULL THEN vnum END AS vnum,
       CASE WHEN leaf.node IS NULL THEN vstr END AS vstr, leaf.node IS NOT NULL AS is_leaf, leaf.results, n,
       mean, var
FROM tree LEFT JOIN leaf ON leaf.node = tree.node
WHERE NOT EXISTS (SELECT 1 FROM leaf l WHERE length(l.node) < length(tree.node) AND starts_with(tree.node, l.node))"""


@register("t5_prune", sql=_prune_sql())
def t5(spark, sf):
    """The order-status tree after merging leaf pairs with a small gain."""
    return _table(TR.prune(_tree(spark, sf), MIN_GAIN))


@register("t6_tree_shape", sql=f"{_tree_sql('entropy')} SELECT count(*) FILTER (is_leaf) AS width, max(depth) AS depth FROM tree")
def t6(spark, sf):
    """Width (leaves) and depth of the order-status tree."""
    return TR.tree_shape(_tree(spark, sf))


@register("t6_tree_listing", sql=f"""{_tree_sql('entropy')}
SELECT node, depth, translate(substr(node, 2), 'TF', '01') AS path,
       CASE WHEN is_leaf THEN results ELSE col || ':' || coalesce(vstr, vnum::VARCHAR) || '?' END AS text FROM tree""")
def t6l(spark, sf):
    """Pre-order listing of the order-status tree."""
    return TR.tree_listing(_tree(spark, sf))


@register("t7_regression_tree", sql=f"{_tree_sql('variance')} {_SELECT_TREE.format('tree')}")
def t7(spark, sf):
    """Variance-reduction tree of the order price."""
    return _table(_price_tree(spark, sf))


def _whole(spark, sf):
    return TR.build_tree(_orders(spark, sf), FEATURES, "o_orderstatus", local_rows=LOCAL_ROWS)


@register("t2_whole_tree")
def t2w(spark, sf):
    """The order-status tree, grown to its end."""
    return _table(_whole(spark, sf))


@register("t3_classify_whole")
def t3w(spark, sf):
    """Every order routed to its leaf of the whole order-status tree."""
    out = TR.classify(_whole(spark, sf), _orders(spark, sf), FEATURES, "o_orderkey")
    return out.select("o_orderkey", "node", F.to_json("results").alias("results"))


@register("t5_prune_whole")
def t5w(spark, sf):
    """The whole order-status tree after merging leaf pairs with a small gain."""
    return _table(TR.prune(_whole(spark, sf), MIN_GAIN))


@register("t6_whole_shape")
def t6w(spark, sf):
    """Width (leaves) and depth of the whole order-status tree."""
    return TR.tree_shape(_whole(spark, sf))


@register("t7_whole_regression")
def t7w(spark, sf):
    """Variance-reduction tree of the order price, grown to its end."""
    o = _orders(spark, sf)
    return _table(TR.build_tree(o, PRICE_FEATURES, "o_totalprice", "variance", local_rows=LOCAL_ROWS))
