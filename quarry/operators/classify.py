"""Document and vector classifiers (inventory A17, B1-B9, B11, B12, B14, F28-F30, F34).

Training state is two long tables: ``fc(feature, cat, n)`` and
``cc(cat, n)``.  The category list is small by nature and is read once on the
driver; per-category quantities then become columns of a feature table, so
scoring is one join of item features with that table and one aggregation
per item (no item x category cross join, and no column named after a category).  Products of probabilities are
sums of logarithms, so long documents do not underflow to 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import vectors as V

WEIGHT, AP = 1.0, 0.5


def train_counts(items: DataFrame, features: str, cat: str, repeat: int = 1) -> tuple[DataFrame, DataFrame]:
    """Documents per (feature, category) and per category.

    ``repeat`` multiplies every count (training the same set n times)."""
    f = items.select(F.explode(F.array_distinct(features)).alias("feature"), F.col(cat).alias("cat"))
    fc = f.groupBy("feature", "cat").agg((F.count(F.lit(1)) * repeat).alias("n"))
    cc = items.groupBy(F.col(cat).alias("cat")).agg((F.count(F.lit(1)) * repeat).alias("n"))
    return fc, cc


def category_list(cc: DataFrame) -> list[tuple]:
    """(cat, count) pairs, sorted by category.  One row per category comes to
    the driver: a classifier's categories are part of its schema, as pivoted
    columns are."""
    return sorted(((r["cat"], r["n"]) for r in cc.collect()), key=lambda x: str(x[0]))


def feature_table(fc: DataFrame, cats: list[tuple], weight: float = WEIGHT, ap: float = AP) -> DataFrame:
    """Per feature: counts ``n_i``, ``fprob_i`` (B2), ``cprob_i`` (B6) and both
    weighted probabilities ``wnb_i`` and ``wfi_i`` (B3), where i is the
    category's place in ``cats``: columns never are named after categories."""
    ids = range(len(cats))
    counts = [F.sum(F.when(F.col("cat").eqNullSafe(F.lit(c)), F.col("n")).otherwise(0)).alias(f"n_{i}")
              for i, (c, _) in enumerate(cats)]
    wide = fc.groupBy("feature").agg(*counts)
    totals = sum((F.col(f"n_{i}") for i in ids), F.lit(0))
    fprob = [(F.col(f"n_{i}").cast("double") / F.lit(float(n))) if n else F.lit(0.0) for i, (_, n) in enumerate(cats)]
    fsum = sum(fprob, F.lit(0.0))
    cols = [F.col("feature")]
    for i in ids:
        cprob = F.when(fprob[i] == 0, F.lit(0.0)).otherwise(fprob[i] / fsum)
        cols += [F.col(f"n_{i}"), fprob[i].alias(f"fprob_{i}"), cprob.alias(f"cprob_{i}"),
                 ((F.lit(weight * ap) + totals * fprob[i]) / (F.lit(weight) + totals)).alias(f"wnb_{i}"),
                 ((F.lit(weight * ap) + totals * cprob) / (F.lit(weight) + totals)).alias(f"wfi_{i}")]
    return wide.select(*cols, totals.alias("totals"))


def _item_feature_scores(items: DataFrame, key: str, features: str, ft: DataFrame, cats, prefix: str,
                         ap: float = AP) -> DataFrame:
    """Per item: ``l_i``, the sum of ln(weighted prob) of category i, and the
    number of features ``nf``.  Unseen features weigh ``ap``; an item without
    features keeps one empty row, so no join with the items is needed."""
    # the set and its size are made before the explode: beside it, the size would
    # be worked out again for every row that comes out of it
    sets = items.select(key, F.array_distinct(features).alias("fs"))
    sets = sets.select(key, F.coalesce(F.size("fs"), F.lit(0)).alias("nf"), "fs")
    f = sets.select(key, "nf", F.explode_outer("fs").alias("feature"))
    j = f.join(ft, "feature", "left")
    part = lambda i: F.log(F.coalesce(F.col(f"{prefix}_{i}"), F.lit(ap)))
    aggs = [F.sum(F.when(F.col("feature").isNotNull(), part(i)).otherwise(0.0)).alias(f"l_{i}") for i in range(len(cats))]
    return j.groupBy(key, "nf").agg(*aggs)


def _long(df: DataFrame, key: str, cats, out: str) -> DataFrame:
    """One row per (item, category) from the columns p_i."""
    pairs = F.array(*[F.struct(F.lit(c).alias("cat"), F.col(f"p_{i}").alias(out)) for i, (c, _) in enumerate(cats)])
    return df.select(key, F.explode(pairs).alias("x")).select(key, "x.cat", f"x.{out}")


def _nb_wide(items: DataFrame, key: str, features: str, fc: DataFrame, cats: list[tuple]) -> DataFrame:
    total = float(sum(n for _, n in cats))
    s = _item_feature_scores(items, key, features, feature_table(fc, cats), cats, "wnb")
    return s.select(key, *[(F.col(f"l_{i}") + F.lit(math.log(n / total))).alias(f"p_{i}") for i, (_, n) in enumerate(cats)])


def nb_scores(items: DataFrame, key: str, features: str, fc: DataFrame, cc: DataFrame) -> DataFrame:
    """Ln P(cat) + sum ln weightedprob(f, cat) per (item, cat)."""
    cats = category_list(cc)
    return _long(_nb_wide(items, key, features, fc, cats), key, cats, "logprob")


def _by_place(place: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), place)


def nb_classify(items: DataFrame, key: str, features: str, fc: DataFrame, cc: DataFrame, thresholds: dict | None = None,
                default=None) -> DataFrame:
    """The best category unless another's probability times the best's
    threshold exceeds the best's (then ``default``).  Log space; the categories
    are columns of the item's row, so the decision is a projection."""
    cats = category_list(cc)
    wide = _nb_wide(items, key, features, fc, cats)
    ranked = F.array_max(F.array(*[F.struct(F.col(f"p_{i}").alias("p"), F.lit(-i).alias("i")) for i in range(len(cats))]))
    wide = wide.select(key, *[f"p_{i}" for i in range(len(cats))], ranked["p"].alias("mx"), (-ranked["i"]).alias("best"))
    thr = _by_place(F.col("best"), [math.log((thresholds or {}).get(c, 1.0)) for c, _ in cats])
    beaten = F.lit(False)
    for i in range(len(cats)):
        beaten = beaten | ((F.col("best") != i) & (F.col(f"p_{i}") + thr > F.col("mx")))
    return wide.select(key, F.when(beaten, F.lit(default)).otherwise(_by_place(F.col("best"), [c for c, _ in cats])).alias("category"))


def inv_chi2(chi: Column, df: Column) -> Column:
    """e^-m sum_{i < df/2} m^i / i!, capped at 1, with m = chi / 2,
    summed in log space."""
    m = chi / 2.0
    n = (df / 2).cast("int")
    seq = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    init = F.struct((-m).alias("lt"), (-m).alias("s"))

    def step(acc, i):
        lt = acc["lt"] + F.log(m) - F.log(i.cast("double"))
        hi = F.greatest(acc["s"], lt)
        return F.struct(lt.alias("lt"), (hi + F.log1p(F.exp(-F.abs(acc["s"] - lt)))).alias("s"))

    total = F.aggregate(seq, init, step)["s"]
    return F.when(m <= 0, F.lit(1.0)).otherwise(F.least(F.exp(total), F.lit(1.0)))


def _fisher_wide(items: DataFrame, key: str, features: str, fc: DataFrame, cats: list[tuple]) -> DataFrame:
    s = _item_feature_scores(items, key, features, feature_table(fc, cats), cats, "wfi")
    return s.select(key, *[inv_chi2(F.lit(-2.0) * F.col(f"l_{i}"), F.col("nf") * 2).alias(f"p_{i}") for i in range(len(cats))])


def fisher_scores(items: DataFrame, key: str, features: str, fc: DataFrame, cc: DataFrame) -> DataFrame:
    """invchi2(-2 sum ln weighted cprob, 2 * features) per (item, cat)."""
    cats = category_list(cc)
    return _long(_fisher_wide(items, key, features, fc, cats), key, cats, "prob")


def fisher_classify(items: DataFrame, key: str, features: str, fc: DataFrame, cc: DataFrame, minimums: dict | None = None,
                    default=None) -> DataFrame:
    """The category with the highest probability above its minimum
    (ties: first category in sort order), else ``default``."""
    cats = category_list(cc)
    minimums = minimums or {}
    wide = _fisher_wide(items, key, features, fc, cats)
    above = [F.when((F.col(f"p_{i}") > float(minimums.get(c, 0.0))) & (F.col(f"p_{i}") > 0),
                    F.struct(F.col(f"p_{i}").alias("p"), F.lit(-i).alias("i"))) for i, (c, _) in enumerate(cats)]
    best = F.array_max(F.array(*above))
    return wide.select(key, F.coalesce(_by_place(-best["i"], [c for c, _ in cats]), F.lit(default)).alias("category"))


# ---- vector classifiers (B11-B14) -----------------------------------------------

def class_means(rows: DataFrame, vec: str, label: str) -> dict:
    """A15 on the driver side: {label: mean vector} (labels x dimensions
    numbers, bounded by the schema, not by the row count)."""
    from quarry.operators.relational import class_means as cm

    out: dict = {}
    for r in cm(rows, vec, label).collect():
        out.setdefault(r[label], {})[r["pos"]] = r["mean"]
    return {k: [v[i] for i in range(len(v))] for k, v in out.items()}


def nearest_mean_classify(points: DataFrame, vec: str, means: dict) -> Column:
    """0 if x.m0 - x.m1 + (m1.m1 - m0.m0)/2 > 0 else 1."""
    m0, m1 = means[0], means[1]
    b = (sum(x * x for x in m1) - sum(x * x for x in m0)) / 2.0
    y = V.dot(vec, V.lit_vector(m0)) - V.dot(vec, V.lit_vector(m1)) + F.lit(b)
    return F.when(y > 0, F.lit(0)).otherwise(F.lit(1))


def kernel_classify(train: DataFrame, vec: str, label: str, queries: list[tuple], offset: float = 0.0,
                    gamma: float = 10.0) -> DataFrame:
    """For each query point, mean RBF similarity to class 0 minus mean
    RBF to class 1 plus ``offset``; class 0 when positive.

    ``queries`` is a bounded list of (query_id, vector); the training table
    is scanned once with one aggregate column pair per query point."""
    aggs = []
    for qid, qv in queries:
        k = V.rbf(vec, V.lit_vector(qv), gamma)
        aggs += [F.sum(F.when(F.col(label) == 0, k)).alias(f"s0_{qid}"),
                 F.sum(F.when(F.col(label) == 1, k)).alias(f"s1_{qid}")]
    aggs += [F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")]
    row = train.agg(*aggs)
    parts = [row.select(F.lit(qid).alias("query_id"),
                        (F.col(f"s0_{qid}") / F.col("n0") - F.col(f"s1_{qid}") / F.col("n1") + F.lit(offset)).alias("y"))
             for qid, _ in queries]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("query_id", "y", F.when(F.col("y") > 0, F.lit(0)).otherwise(F.lit(1)).alias("predicted"))


def min_max_scale(df: DataFrame, vec: str, lows: list, highs: list) -> Column:
    """(x - low) / (high - low) per dimension; a constant dimension
    scales to 0 (the reference divides by zero)."""
    lo = V.lit_vector(lows)
    rng = V.lit_vector([h - l for l, h in zip(lows, highs)])
    return F.zip_with(F.zip_with(F.col(vec), lo, lambda x, l: x.cast("double") - l), rng,
                      lambda d, r: F.when(r == 0, F.lit(0.0)).otherwise(d / r))
