"""Similarity and recommendation (inventory R1-R8, J4, J5, K1, W6).

Preferences are a long table ``(user_id, item_id, rating double)``; the
item-centred view is the same table with the two key columns swapped (R5).
Every similarity is an aggregate over the co-rated join (J4), so a pair
score never needs the two users' rating maps on one machine.

Scores that decide a ranking are rounded to ``SCORE_DIGITS`` decimals first,
so that sums taken in a different order rank the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.dist import pair_join, top_n_per_key
from quarry.session import cut_lineage

SCORE_DIGITS = 9
LOT_PAIRS = 150_000_000     # pairs of ratings whose lists are on disk at once, about 3 GB
TASK_ROWS = 2_000_000       # rows that a task sums up, by count: compressed bytes would let a task take many more


def transpose(prefs: DataFrame) -> DataFrame:
    """Swap user and item."""
    return prefs.select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), "rating")


_SUMS = {
    "n": lambda: F.count(F.lit(1)),
    "s1": lambda: F.sum("ra"), "s2": lambda: F.sum("rb"),
    "q1": lambda: F.sum(F.col("ra") * F.col("ra")), "q2": lambda: F.sum(F.col("rb") * F.col("rb")),
    "p": lambda: F.sum(F.col("ra") * F.col("rb")),
    "sq": lambda: F.sum(F.pow(F.col("ra") - F.col("rb"), 2)),
}
NEEDS = {"distance": ["n", "sq"], "pearson": ["n", "s1", "s2", "q1", "q2", "p"]}


def _pair_sums(joined: DataFrame, ka: str, kb: str, measures: list[str] | None = None) -> DataFrame:
    """Co-rated sums per pair; ``joined`` has columns ka, kb, ra, rb.  Only
    the sums a similarity needs are computed (``measures``)."""
    names = measures or list(_SUMS)
    return joined.groupBy(ka, kb).agg(*[_SUMS[m]().alias(m) for m in names])


def distance_score(sums_prefix: str = "") -> Column:
    """R1 from pair sums: 1 / (1 + sum of squared differences)."""
    return F.lit(1.0) / (F.lit(1.0) + F.round(F.col(sums_prefix + "sq"), SCORE_DIGITS))


def pearson_score() -> Column:
    """R2 from pair sums; 0 when the denominator is 0 (radicand clamped)."""
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    num = F.col("p") - s1 * s2 / n
    rad = (F.col("q1") - s1 * s1 / n) * (F.col("q2") - s2 * s2 / n)
    den = F.sqrt(F.greatest(rad, F.lit(0.0)))
    return F.round(F.coalesce(F.try_divide(num, F.when(den != 0, den)), F.lit(0.0)), SCORE_DIGITS)


SIMILARITIES = {"distance": distance_score, "pearson": pearson_score}


def _sim_col(similarity) -> Column:
    if callable(similarity):
        return similarity()
    return SIMILARITIES[similarity]()


def co_rated(prefs: DataFrame, person1, person2) -> DataFrame:
    """Items rated by both persons, with both ratings."""
    a = prefs.where(F.col("user_id") == F.lit(person1)).select("item_id", F.col("rating").alias("ra"))
    b = prefs.where(F.col("user_id") == F.lit(person2)).select("item_id", F.col("rating").alias("rb"))
    return a.join(b, "item_id")


def similarity_to_all(prefs: DataFrame, person, similarity="pearson") -> DataFrame:
    """Similarity of ``person`` to every other user with a co-rated item.

    Output ``(other, score)``.  One join on item (the person's rows against
    all rows), then one partial aggregation by the other user."""
    mine = prefs.where(F.col("user_id") == F.lit(person)).select("item_id", F.col("rating").alias("ra"))
    others = prefs.where(F.col("user_id") != F.lit(person)).select(
        F.col("user_id").alias("other"), "item_id", F.col("rating").alias("rb"))
    j = others.join(mine, "item_id").withColumn("_k", F.lit(0))
    sums = _pair_sums(j, "_k", "other", NEEDS.get(similarity) if isinstance(similarity, str) else None)
    return sums.select("other", _sim_col(similarity).alias("score"))


def sim_pair(prefs: DataFrame, person1, person2, similarity="pearson") -> DataFrame:
    """R1 / R2 for one pair: a one-row frame ``(score)``; 0 with no overlap.

    A global aggregate always returns one row, even over no co-rated item."""
    j = co_rated(prefs, person1, person2)
    sums = j.agg(*[_SUMS[m]().alias(m) for m in _SUMS])
    return sums.select(F.when(F.col("n") == 0, F.lit(0.0)).otherwise(_sim_col(similarity)).alias("score"))


def top_matches(prefs: DataFrame, person, n: int = 5, similarity="pearson") -> DataFrame:
    """R3 + K1: the ``n`` best other users by (score desc, name desc); users
    without overlap score 0 and stay eligible."""
    users = prefs.where(F.col("user_id") != F.lit(person)).select(F.col("user_id").alias("other")).distinct()
    sims = similarity_to_all(prefs, person, similarity)
    scored = users.join(sims, "other", "left").select("other", F.coalesce("score", F.lit(0.0)).alias("score"))
    return scored.orderBy(F.desc("score"), F.desc("other")).limit(n)


def user_recommendations(prefs: DataFrame, person, similarity="pearson") -> DataFrame:
    """Similarity-weighted mean of other users' ratings over items the
    person has not rated (or rated 0); only positive similarities count."""
    sims = similarity_to_all(prefs, person, similarity).where(F.col("score") > 0)
    seen = prefs.where((F.col("user_id") == F.lit(person)) & (F.col("rating") != 0)).select("item_id")
    cand = (prefs.join(sims, prefs.user_id == sims.other)
            .join(seen, "item_id", "left_anti"))
    return (cand.groupBy("item_id")
            .agg((F.sum(F.col("rating") * F.col("score")) / F.sum("score")).alias("score"))
            .select("item_id", "score"))


def item_pair_sums(prefs: DataFrame, heavy_rows: int = 4_000, measures: list[str] | None = None) -> DataFrame:
    """Co-rating sums for every item pair (a < b) that shares a rater.

    The self-join is on the rater; raters with more than ``heavy_rows``
    ratings are dealt into a grid of tasks (``pair_join``).  Only a < b is built; the caller
    mirrors.  Output: item_a, item_b and the sums n s1 s2 q1 q2 p sq."""
    a = prefs.select("user_id", F.col("item_id").alias("item_a"), F.col("rating").alias("ra"))
    b = prefs.select("user_id", F.col("item_id").alias("item_b"), F.col("rating").alias("rb"))
    j = pair_join(a, b, "user_id", heavy_rows=heavy_rows).where(F.col("item_a") < F.col("item_b"))
    return _pair_sums(j, "item_a", "item_b", measures)


def similar_items(prefs: DataFrame, n: int = 10, heavy_rows: int = 4_000, lot_pairs: int = LOT_PAIRS) -> DataFrame:
    """For each item the ``n`` most similar items by distance
    similarity, ties by item id descending.  Items that share no rater are
    left out (they would score 0).  Output (item_id, other_item, similarity,
    rank).

    Every rating moves to its item with the list of its rater's ratings (in
    pieces of ``heavy_rows / 8``, so that rows stay short), and one task sums the
    pairs of its items in both directions and drops all but the nearest: pairs
    are not shuffled. Items come in lots of about ``lot_pairs`` pairs, counted
    first; disk holds the lists of one lot."""
    known = prefs.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    counts = known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
    lots = max(1, math.ceil(pairs / lot_pairs))
    tasks = max(1, math.ceil(pairs / lots / TASK_ROWS))
    pieces = F.ceil(F.col("n") / max(1, heavy_rows // 8))
    lists = (known.join(counts, "user_id").groupBy("user_id", F.pmod(F.xxhash64("item_id"), pieces).alias("piece"))
             .agg(F.collect_list(F.struct("item_id", "rating")).alias("x"))
             .select("user_id", F.col("x.item_id").alias("others"), F.col("x.rating").alias("rbs")))
    lists = cut_lineage(lists)
    kind = prefs.schema["item_id"].dataType.simpleString()
    parts = []
    for lot in range(lots):
        own = known.where(F.pmod(F.xxhash64("item_id", F.lit("lot")), F.lit(lots)) == lot)
        dealt = (own.select("user_id", F.col("item_id").alias("item_a"), F.col("rating").alias("ra")).join(lists, "user_id")
                 .select("item_a", "ra", "others", "rbs").repartition(tasks, "item_a"))
        s = (dealt.mapInArrow(_nearest(n), f"item_a {kind}, item_b {kind}, sq double")
             .select("item_a", "item_b", distance_score().alias("similarity")))
        top = top_n_per_key(s, "item_a", [F.desc("similarity"), F.desc("item_b")], n)
        parts.append(cut_lineage(top.select(F.col("item_a").alias("item_id"), F.col("item_b").alias("other_item"), "similarity", "rank")))
    return reduce(DataFrame.unionByName, parts)


def _nearest(n: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from all ratings of some items, each with ratings of the same
    rater, to (item_a, item_b, sq): per item_a the pairs that can be among the
    ``n`` with the smallest sums, equal ones by item_b descending."""

    def summed(held: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(held).group_by(["item_a", "item_b"], use_threads=False).aggregate([("sq", "sum")])
        return t.select(["item_a", "item_b", "sq_sum"]).rename_columns(["item_a", "item_b", "sq"])

    def best(t: pa.Table) -> pa.Table:
        # not-a-number sorts before, null after all other sums, as a similarity does in Spark
        order = pc.fill_null(t["sq"], math.inf)
        t = t.append_column("o", pc.if_else(pc.is_nan(order), -math.inf, order))
        t = t.take(pc.sort_indices(t, [("item_a", "ascending"), ("o", "ascending"), ("item_b", "descending")]))
        item, o = t["item_a"].combine_chunks().dictionary_encode().indices.to_numpy(), t["o"].to_numpy()
        new = np.append(True, item[1:] != item[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))
        tie = np.maximum.accumulate(np.where(new | np.append(True, o[1:] != o[:-1]), np.arange(len(o)), 0))
        last = np.minimum(first + n - 1, np.append(np.flatnonzero(new)[1:], len(o))[np.cumsum(new) - 1] - 1)
        # sums are rounded later: those within rounding of the n-th stay too
        keep = (np.arange(len(o)) - tie < n) & (o <= o[last] + 1e-6 * np.maximum(1.0, np.where(np.isfinite(o[last]), np.abs(o[last]), 1.0)))
        return t.filter(pa.array(keep)).drop_columns(["o"])

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, limit = [], 0, TASK_ROWS
        for x in batches:
            at = pc.list_parent_indices(x["others"])
            t = pa.table({"item_a": x["item_a"].take(at), "item_b": pc.list_flatten(x["others"]),
                          "sq": pc.power(pc.subtract(x["ra"].take(at), pc.list_flatten(x["rbs"])), 2.0)})
            t = t.filter(pc.not_equal(t["item_a"], t["item_b"]))
            held, rows = [*held, t], rows + len(t)
            if rows > 2 * limit:
                held = [summed(held)]
                rows = len(held[0])
                limit = max(limit, rows)
        if rows:
            yield from best(summed(held)).to_batches()

    return pairs


def item_recommendations(prefs: DataFrame, item_match: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """For each user, unrated items scored by the similarity-weighted
    mean of the user's ratings over the neighbour lists of ``item_match``.

    ``users`` (one column user_id) restricts the users; default all.  The
    neighbour table has a bounded number of rows per item, so the join fans
    out at most n times the ratings. A rating moves to its user with its
    item's neighbours as one array and leads to candidates only there, where a
    row for the rated item itself marks it as seen."""
    r = prefs if users is None else prefs.join(users, "user_id", "left_semi")
    kind = prefs.schema["item_id"].dataType
    near = (item_match.where(F.col("item_id").isNotNull())
            .groupBy("item_id").agg(F.collect_list(F.struct(F.col("other_item").cast(kind).alias("item_id"), "similarity")).alias("near")))
    dealt = r.join(near, "item_id", "left").select("user_id", "item_id", "rating", "near")
    dealt = dealt.repartition(max(1, math.ceil(11 * r.count() / TASK_ROWS)), "user_id")
    score = F.col("x.similarity")
    # a null user or item equals no other: it marks nothing
    known = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    own = F.struct(F.col("item_id"), F.lit(None).cast("double").alias("similarity"))
    none = F.array().cast(near.schema["near"].dataType)
    rows = F.concat(F.when(known, F.array(own)).otherwise(none), F.coalesce("near", none))
    return (dealt.select("user_id", "rating", F.posexplode(rows).alias("pos", "x"), known.alias("known"))
            .groupBy("user_id", F.col("x.item_id").alias("item_id"))
            .agg((F.sum(score * F.col("rating")) / F.sum(score)).alias("score"),
                 F.max(F.col("known") & (F.col("pos") == 0)).alias("seen"))
            .where(~F.col("seen")).select("user_id", "item_id", "score"))


def unseen_items(prefs: DataFrame, person, include_zero: bool = True) -> DataFrame:
    """Items some user rated that ``person`` has not rated (or rated 0)."""
    seen = prefs.where(F.col("user_id") == F.lit(person))
    if include_zero:
        seen = seen.where(F.col("rating") != 0)
    return prefs.select("item_id").distinct().join(seen.select("item_id"), "item_id", "left_anti")
