"""Cross-site boilerplate lines.

A line's spread is the number of distinct sites that hold it. Each line's hash
gets a HyperLogLog sketch of its sites; sketches merge by aggregation, map side
first, so a line on a third of all rows is one row per task when it is
shuffled. Lines whose estimate lies near the threshold get an exact distinct
count; the others are clear from the sketch. Lines of ``min_sites`` sites or
more are boilerplate.

Of a boilerplate line the first copy stays (smallest document id, then place),
so that a text copied to many sites leaves the corpus only as a copy.

Defined cases: a null or blank line is never boilerplate, a null site counts
for none, a null text is kept as it is, and repeated rows share one key: all of
them keep or lose the same lines. Of the input's columns only the named ones
are read; all are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, hashed_key

SKETCH_BITS = 12  # relative standard error 1.04 / sqrt(2 ** 12) = 1.6 %
NEAR = 0.1  # six standard errors


def _line_key(line: Column) -> list[Column]:
    """96 bits for a line without its outer white space."""
    trimmed = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return [F.when(trimmed != "", F.xxhash64(trimmed)).alias("h1"), F.hash(trimmed).alias("h2")]


def lines_of(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """(k1, k2, doc_id, site, line_no, h1, h2) of every line with a word."""
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    split = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(doc_id).alias("doc_id"), F.col(site).alias("site"),
                        F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return split.select("k1", "k2", "doc_id", "site", "line_no", *_line_key(F.col("line"))).where(F.col("h1").isNotNull())


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """(h1, h2, first) of the lines on ``min_sites`` sites or more; ``first``
    is the place of the copy that stays."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "line_no")
    spread = (lines.groupBy("h1", "h2")
              .agg(F.hll_sketch_agg(F.xxhash64("site"), F.lit(SKETCH_BITS)).alias("sketch"),
                   F.count("site").alias("n"), F.min(place).alias("first"))
              # a line with fewer rows than the threshold cannot reach it
              .where(F.col("n") >= min_sites)
              .select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("estimate")))
    spread = cut_lineage(spread)
    # the sketch counts a null site as a value: one more than the real spread at most
    low, high = min_sites * (1 - NEAR) - 1, min_sites * (1 + NEAR) + 1
    sure = spread.where(F.col("estimate") > high).select("h1", "h2", "first")
    near = spread.where(F.col("estimate").between(low, high)).select("h1", "h2", "first")
    exact = (lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
             .select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").agg(F.count("site").alias("n_sites"))
             .where(F.col("n_sites") >= min_sites).select("h1", "h2"))
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi"))


def remove(docs: DataFrame, min_sites: int = 10, doc_id: str = "doc_id", text: str = "text",
           site: str = "source") -> DataFrame:
    """``docs`` with the boilerplate lines cut from the text, plus ``n_lines``
    (\\n-split lines of the whole text; null text: 0) and ``n_removed``. Input
    columns of these two names are replaced."""
    lines = lines_of(docs, doc_id, text, site)
    common = boilerplate(lines, min_sites)
    first = F.col("first")
    stays = ((F.col("k1") == first["k1"]) & (F.col("k2") == first["k2"]) & (F.col("line_no") == first["line_no"]))
    cut = (lines.select("k1", "k2", "line_no", "h1", "h2").join(common, ["h1", "h2"]).where(~stays)
           .groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
           .agg(F.collect_set("line_no").alias("__cut")))
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    rows = docs.withColumns({"__a": k1, "__b": k2}).join(
        cut, (F.col("__a") == F.col("__k1")) & (F.col("__b") == F.col("__k2")), "left")
    n = F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0))
    rows = rows.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(n).cast("long"))
    rows = rows.withColumn("__l", F.when(F.col("__cut").isNotNull(), F.split(F.col(text), "\n")))
    keep = F.array_except(F.sequence(F.lit(0), F.size("__l") - 1), F.col("__cut"))
    left = F.array_join(F.transform(keep, lambda i: F.get(F.col("__l"), i)), "\n")
    return (rows.withColumn(text, F.when(F.col("__cut").isNull(), F.col(text)).otherwise(left))
            .withColumn("n_removed", F.coalesce(F.size("__cut"), F.lit(0)).cast("long"))
            .withColumn("n_removed", F.when(F.col("__cut").isNull(), F.lit(0)).otherwise(F.col("n_removed")).cast("long"))
            .drop("__a", "__b", "__k1", "__k2", "__cut", "__l"))
