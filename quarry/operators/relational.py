"""Filters, aggregates, windows, set operations and top-k (inventory P, A,
S, K, W rows).  All are plain DataFrame plans: filters reach the parquet scan,
aggregates run partial + final, windows keep a per-key top-n limit before the
shuffle (Spark's window group limit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from quarry.functions import text as T
from quarry.session import cut_lineage


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- predicates (P) ------------------------------------------------------------

def threshold_filter(df: DataFrame, col: str, t) -> DataFrame:
    """Keep rows with col > t (strict)."""
    return df.where(F.col(col) > F.lit(t))


def open_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Lo < col < hi, sorted by col."""
    return df.where((F.col(col) > F.lit(lo)) & (F.col(col) < F.lit(hi))).orderBy(col)


def member_filter(df: DataFrame, col: str, values: list) -> DataFrame:
    """Scalar in list, or an array column with any element in the list."""
    if isinstance(df.schema[col].dataType, ArrayType):
        return df.where(F.arrays_overlap(F.col(col), F.array(*[F.lit(v) for v in values])))
    return df.where(F.col(col).isin(values))


def iregex_filter(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Contains a match of ``pattern`` ignoring case."""
    return df.where(F.col(col).rlike("(?i)" + pattern))


def lower_contains(df: DataFrame, col: str, s: str) -> DataFrame:
    """P5: lower(col) contains s."""
    return df.where(F.lower(F.col(col)).contains(s.lower()))


def json_key_equals(df: DataFrame, col: str, key: str, value) -> DataFrame:
    """A JSON key is present and equals ``value``."""
    v = F.get_json_object(F.col(col), f"$.{key}")
    return df.where(v.isNotNull() & (v == F.lit(str(value))))


def long_text(df: DataFrame, col: str, n: int = 1000) -> DataFrame:
    """Character length above n."""
    return df.where(F.length(F.col(col)) > n)


def split_branch(df: DataFrame, col: str, value) -> DataFrame:
    """Branch flag, ``>=`` for numeric columns, ``=`` otherwise."""
    if isinstance(df.schema[col].dataType, NumericType):
        cond = F.col(col) >= F.lit(value)
    else:
        cond = F.col(col) == F.lit(value)
    return df.withColumn("branch", F.coalesce(cond, F.lit(False)))


def first_per_key(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The first row of each key by the explicit sequence column."""
    w = Window.partitionBy(key).orderBy(seq)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def rescale(vec, scale: list) -> Column:
    """Multiply each input by its weight; output length = len(scale)."""
    sc = F.array(*[F.lit(float(s)) for s in scale])
    return F.zip_with(F.slice(_c(vec), 1, len(scale)), sc, lambda a, b: a.cast("double") * b)


# ---- aggregates (A) ------------------------------------------------------------

def frequency(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """A1: counts, most common first, ties by key ascending; top n."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))
    return out.limit(n) if n else out


def count_at_least(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """A2: keys with count >= min_count (HAVING)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def year_month_counts(df: DataFrame, ts: str) -> DataFrame:
    """A3: rows per (year, month), sorted."""
    return (df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("year", "month"))


def sorted_set_per_key(df: DataFrame, key: str, col: str) -> DataFrame:
    """A4: the distinct values of col per key, as a sorted array.

    Distinct first (partial aggregation), so a hot key carries each value
    once."""
    d = df.select(key, col).distinct()
    return d.groupBy(key).agg(F.array_sort(F.collect_list(col)).alias("values"))


def lexical_diversity(tokens: DataFrame, key: str, word: str = "word") -> DataFrame:
    """Distinct / total words per key (null for no words)."""
    return tokens.groupBy(key).agg(
        (F.countDistinct(word) / F.count(word)).alias("diversity"))


def avg_words(df: DataFrame, col: str) -> DataFrame:
    """A10: mean whitespace-token count; a blank text counts 0."""
    n = F.size(F.filter(F.split(F.trim(F.col(col)), "\\s+"), lambda x: x != F.lit("")))
    return df.agg(F.avg(n).alias("avg_words"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Label histogram."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def impurity(df: DataFrame, label: str, group: list | None = None) -> DataFrame:
    """A12 + A13: Gini impurity and base-2 entropy of the label, per group."""
    group = group or []
    counts = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("c"))
    tot = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    p = counts.withColumn("p", F.col("c") / F.sum("c").over(tot))
    return p.groupBy(*group).agg(
        (F.lit(1.0) - F.sum(F.col("p") * F.col("p"))).alias("gini"),
        (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))


def variance(df: DataFrame, col: str, group: list | None = None) -> DataFrame:
    """Population variance, 0 on empty."""
    group = group or []
    return df.groupBy(*group).agg(F.coalesce(F.var_pop(col), F.lit(0.0)).alias("variance"))


def long_vectors(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, pos, x) rows of an array column (0-based pos)."""
    return df.select(id_col, *[c for c in df.columns if c not in (id_col, vec)],
                     F.posexplode(vec).alias("pos", "x"))


def class_means(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Per label and dimension, the mean value."""
    lv = df.select(label, F.posexplode(vec).alias("pos", "x"))
    return lv.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def min_max(df: DataFrame, vec: str) -> DataFrame:
    """Per dimension the minimum and maximum."""
    lv = df.select(F.posexplode(vec).alias("pos", "x"))
    return lv.groupBy("pos").agg(F.min(F.col("x").cast("double")).alias("low"),
                                 F.max(F.col("x").cast("double")).alias("high"))


def mse(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Mean squared error (null on empty input)."""
    return df.agg(F.avg(F.pow(F.col(y) - F.col(yhat), 2)).alias("mse"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max; the max falls in the last
    bin.  The range is one aggregate row fetched first (two scalars)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, n long")
    if hi == lo:
        b = F.lit(0)
    else:
        b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
    return (df.where(F.col(col).isNotNull()).select(b.cast("int").alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))


def rank_frequency(tokens: DataFrame, word: str = "word") -> DataFrame:
    """A20 + W7: word counts with their global rank (count desc, word asc)."""
    counts = tokens.groupBy(word).agg(F.count(F.lit(1)).alias("n"))
    return global_rank(counts, [F.desc("n"), F.asc(word)])


def word_counts(tokens: DataFrame, key: str, word: str = "word") -> tuple[DataFrame, DataFrame]:
    """(key, word, n) and (word, n)."""
    per = tokens.groupBy(key, word).agg(F.count(F.lit(1)).alias("n"))
    corpus = per.groupBy(word).agg(F.sum("n").alias("n"))
    return per, corpus


# ---- sets (S) -------------------------------------------------------------------

def set_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of a-b, b-a and a n b, one row per part."""
    def size(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return (size(a.subtract(b), "a_only").unionByName(size(b.subtract(a), "b_only"))
            .unionByName(size(a.intersect(b), "both")))


def words_common_to_group(df: DataFrame, group: str, doc: str, tokens_col: str) -> DataFrame:
    """Words present in every document of a group.

    Expressed as counts (documents of the group holding the word equals the
    documents of the group), so no group is ever collected into one row."""
    d = df.select(group, doc, F.explode(F.array_distinct(tokens_col)).alias("word")).distinct()
    per_word = d.groupBy(group, "word").agg(F.countDistinct(doc).alias("k"))
    per_group = df.select(group, doc).distinct().groupBy(group).agg(F.count(F.lit(1)).alias("m"))
    return per_word.join(per_group, group).where(F.col("k") == F.col("m")).select(group, "word")


# ---- windows (W) ----------------------------------------------------------------

def adjacent_pairs(docs: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, pos, w1, w2) of adjacent words of the array ``words``;
    pairs are made inside the row, no word is shuffled."""
    w = F.col("_w")
    t = docs.select(key, words.alias("_w"))   # materialised once; the lambda must not split the text again
    pairs = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                        lambda x, i: F.struct(i.alias("pos"), x.alias("w1"), F.get(w, i + 1).alias("w2")))
    return t.select(key, F.explode(pairs).alias("p")).select(key, "p.pos", "p.w1", "p.w2")


def islands(df: DataFrame, key: list, order: str, gap: int) -> DataFrame:
    """Gaps-and-islands: rows of a key whose ordered values are closer
    than ``gap`` share an island id (0-based)."""
    w = Window.partitionBy(*key).orderBy(order)
    prev = F.lag(order).over(w)
    brk = F.when(prev.isNull() | ((F.col(order) - prev) >= gap), 1).otherwise(0)
    return (df.withColumn("_brk", brk)
            .withColumn("island", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
            .drop("_brk"))


def word_set_col(c) -> Column:
    return T.word_set(c)


def global_rank(df: DataFrame, order_cols: list, rank_col: str = "rank") -> DataFrame:
    """1-based position of each row in a total order, computed distributed.

    A window without partition keys would move every row into one task;
    instead the rows are range-partitioned, sorted and written with their place
    in their partition, and each partition's first rank (one number per
    partition) is added."""
    ordered = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    # monotonically_increasing_id: partition in the high bits, place in the low 33
    placed = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).cast("int")
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    first, at = [], 0
    for p in range(max(sizes, default=-1) + 1):
        first.append(at)
        at += sizes.get(p, 0)
    base = F.get(F.array(*[F.lit(x).cast("long") for x in first]), part) if first else F.lit(0)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(rank_col, base + place + 1).drop("_id")
