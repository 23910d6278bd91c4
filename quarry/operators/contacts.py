"""Contact and title operators (inventory J6, J11, C9-C11, C13, H8, H9).

Titles are compared by the Jaccard distance of their word sets.  The join
orders each title's words from rare to common and meets titles on a prefix of
them: two sets with similarity above t must share one of the first
``n - ceil(t n) + 1`` words, so no pair above the threshold is lost and common
words, which would pair everything, are only met at the end of short titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.components import components
from quarry.operators.relational import global_rank


def similar_titles(titles: DataFrame, title: str, distance: float = 0.5, inclusive: bool = False) -> DataFrame:
    """(a, b, distance) of different titles, a < b, at a Jaccard distance
    below ``distance``, or at most that if ``inclusive``."""
    words = titles.select(F.col(title).alias("t")).where(F.col(title).isNotNull()).distinct()
    words = words.select("t", F.array_distinct(T.ws_tokens("t")).alias("w")).where(F.size("w") > 0)
    rows = words.select("t", F.size("w").alias("n"), F.explode("w").alias("x"))
    use = rows.groupBy("x").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("t").orderBy("df", "x"))
    least = F.col("n") - F.ceil(F.lit(1.0 - distance) * F.col("n")) + 1
    prefix = rows.join(use, "x").withColumn("p", place).where(F.col("p") <= least).select("t", "x")
    met = (prefix.select(F.col("t").alias("a"), "x").join(prefix.select(F.col("t").alias("b"), "x"), "x")
           .where("a < b").select("a", "b").distinct())
    wa, wb = words.select(F.col("t").alias("a"), F.col("w").alias("wa")), words.select(F.col("t").alias("b"), F.col("w").alias("wb"))
    d = T.jaccard_distance("wa", "wb")
    return met.join(wa, "a").join(wb, "b").select("a", "b", d.alias("distance")).where(
        F.col("distance") <= distance if inclusive else F.col("distance") < distance)


def title_clusters(titles: DataFrame, title: str, distance: float = 0.5) -> DataFrame:
    """(cluster, member): for each title itself and every title near it;
    titles without a near one have no cluster (Q19)."""
    near = similar_titles(titles, title, distance)
    both = near.select(F.col("a").alias("cluster"), F.col("b").alias("member")).union(near.select("b", "a"))
    return both.union(both.select("cluster", F.col("cluster").alias("member")).distinct())


def title_sketches(titles: DataFrame, title: str, bands: int = 24, rows: int = 2) -> DataFrame:
    """The sketch index of C10: (t, band, sketch), ``bands`` rows for every
    different title with a word. A sketch joins ``rows`` least word hashes, so
    two titles of similarity s share a band's sketch with probability s^rows."""
    words = titles.select(F.col(title).alias("t")).where(F.col(title).isNotNull()).distinct()
    words = words.select("t", F.array_distinct(T.ws_tokens("t")).alias("w")).where(F.size("w") > 0)
    least = lambda i: F.array_min(F.transform("w", lambda x: F.md5(F.concat(F.lit(f"{i}:"), x))))
    sketches = F.array(*[F.concat(*[least(b * rows + r) for r in range(rows)]) for b in range(bands)])
    return words.select("t", F.posexplode(sketches).alias("band", "sketch"))


def sketched_clusters(titles: DataFrame, title: str, distance: float = 0.5, bands: int = 24, rows: int = 2) -> DataFrame:
    """(cluster, member) like ``title_clusters``, but titles are compared
    only where the sketches of a band agree. Every title is in the index and
    every candidate is compared exactly, so no wrong pair is found; a pair of
    similarity s is missed with probability (1 - s^rows)^bands."""
    index = title_sketches(titles, title, bands, rows)
    met = (index.withColumnRenamed("t", "a").join(index.withColumnRenamed("t", "b"), ["band", "sketch"])
           .where("a < b").select("a", "b").distinct())
    near = met.where(T.jaccard_distance(T.ws_tokens("a"), T.ws_tokens("b")) < distance)
    both = near.select(F.col("a").alias("cluster"), F.col("b").alias("member")).union(near.select("b", "a"))
    return both.union(both.select("cluster", F.col("cluster").alias("member")).distinct())


def level_clusters(titles: DataFrame, title: str, distance: float = 0.5) -> DataFrame:
    """C11: (cluster, member): the clusters of single-linkage clustering cut at
    ``distance``, named by their first title; clusters of one are left out.

    Two titles are in one cluster of that level exactly if a chain of pairs at
    most ``distance`` apart joins them: the components of the near pairs."""
    return components(similar_titles(titles, title, distance, inclusive=True), "a", "b").select(
        F.col("component").alias("cluster"), F.col("id").alias("member"))


def roll_up(clusters: DataFrame, contacts: DataFrame, title: str, contact: str) -> DataFrame:
    """(cluster, contact): the contacts whose title is in a cluster, one
    row for each matching title."""
    return (clusters.join(contacts.select(F.col(title).alias("member"), contact), "member")
            .select("cluster", "member", contact))


def job_roles(df: DataFrame, title: str, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """H8: counts of whole titles (cut at slashes, abbreviations expanded) and
    of their capitalised words, each used ``least`` times or more; words longer
    than two characters."""
    whole = df.select(F.explode(F.transform(T.slash_parts(title), lambda x: F.trim(T.job_title(x)))).alias("title")).where("title <> ''")
    titles = whole.groupBy("title").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    words = (whole.select(F.explode(T.title_tokens("title")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
             .where((F.col("n") >= least) & (F.length("word") > 2)))
    return titles, words


def location_report(df: DataFrame, location: Column, places: DataFrame) -> DataFrame:
    """H9: (location, state, n): cleaned names looked up in a table of places
    (location, address), and the state code of the address found."""
    clean = df.select(T.region_name(location).alias("location")).where("location <> ''")
    n = clean.groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    return (n.join(places.select("location", "address"), "location", "left")
            .select("location", T.state_code(F.coalesce("address", F.lit(""))).alias("state"), "n"))


def placemarks(people: DataFrame, label: str, name: str, places: DataFrame, centroids: DataFrame, chunk: int = 1000) -> DataFrame:
    """IO21: (label, part, coords, contacts): for every place of ``places``
    (label, lat, lon) at which someone is, its coordinates as ``lon,lat`` and
    the names of the people there in order, one a line; then a row labelled
    CENTROID for each of ``centroids`` (lat, lon).

    A place of more than ``chunk`` people has several rows (``part`` 0, 1, ...),
    so a row stays bounded. People are numbered by a distributed sort, so a
    place that holds most of them gathers in no task. A null name counts as
    empty; people at no known place are left out."""
    coords = F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string"))
    known = places.select(F.col("label").alias("_label"), coords.alias("coords"))
    who = people.select(F.col(label).alias("label"), F.coalesce(F.col(name).cast("string"), F.lit("")).alias("name"))
    placed = global_rank(who.join(known, F.col("label") == F.col("_label")).drop("_label"), ["label", "name"])
    first = placed.groupBy("label").agg(F.min("rank").alias("first"))
    rows = placed.join(first, "label").withColumn("part", F.floor((F.col("rank") - F.col("first")) / chunk).cast("int"))
    marks = rows.groupBy("label", "part", "coords").agg(F.array_join(F.array_sort(F.collect_list("name")), "\n").alias("contacts"))
    means = centroids.select(F.lit("CENTROID").alias("label"), F.lit(0).alias("part"), coords.alias("coords"), F.lit(None).cast("string").alias("contacts"))
    return marks.select("label", "part", "coords", "contacts").unionByName(means)
