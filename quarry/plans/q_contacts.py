"""Registered queries: titles, companies and places over the part, customer and
nation tables; titles are spelled out of part names and types."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import contacts as C
from quarry.plans.registry import register
from quarry.sources.tables import Tables

# The same expressions in both dialects.
TITLE = "concat('Sr. ', p_name, CASE WHEN p_size % 3 = 0 THEN '/VP ' ELSE ' / Jr ' END, p_type, CASE WHEN p_size % 2 = 0 THEN ' and CTO & Co' ELSE '' END)"
COMPANY = "concat(p_brand, CASE p_partkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ', LLP' ELSE ' Inc' END)"
PLACE = "concat('Greater ', n_name, ' Area')"
ADDRESS = "concat('Main St 1, City ', substr('CATXNYWAOR', 1 + 2 * (n_nationkey % 5), 2), ' 9000')"
_WS = r"list_filter(regexp_split_to_array({c}, '\s+'), lambda x: x <> '')"


def _fold_sql(c: str, pairs) -> str:
    for old, new in pairs:
        c = f"replace({c}, '{old}', '{new}')"
    return c


_SUFFIXES = [(s, "") for s in T.COMPANY_SUFFIXES]


@register("h7_company_distribution", sql=f"""SELECT company, count(*) AS n FROM (
  SELECT {_fold_sql(f'trim({COMPANY})', _SUFFIXES)} AS company FROM part) GROUP BY company HAVING count(*) > 1""")
def h7(spark, sf):
    """Companies (part brands with a legal form) after the suffix removals,
    names used more than once."""
    p = Tables(spark, sf).part
    c = p.select(T.company_name(F.expr(COMPANY)).alias("company")).groupBy("company").agg(F.count(F.lit(1)).alias("n"))
    return c.where(F.col("n") > 1)


@register("f12_job_titles", sql=f"SELECT p_partkey, {_fold_sql(TITLE, T.TITLE_EXPANSIONS)} AS title FROM part")
def f12(spark, sf):
    """Title abbreviations expanded in order."""
    return Tables(spark, sf).part.select("p_partkey", T.job_title(F.expr(TITLE)).alias("title"))


@register("f13_title_parts", sql=f"""SELECT p_partkey, unnest(list_filter(list_transform(regexp_split_to_array({TITLE}, '/| and |&'), lambda x: trim(x)), lambda x: x <> '')) AS part FROM part""")
def f13(spark, sf):
    """Titles cut at slashes, 'and' and ampersands."""
    return Tables(spark, sf).part.select("p_partkey", F.explode(T.title_parts(F.expr(TITLE))).alias("part"))


@register("f14_slash_parts", sql=f"SELECT p_partkey, unnest(list_transform(string_split({TITLE}, '/'), lambda x: trim(x))) AS part FROM part")
def f14(spark, sf):
    """Titles cut at slashes."""
    return Tables(spark, sf).part.select("p_partkey", F.explode(T.slash_parts(F.expr(TITLE))).alias("part"))


_ROLES_SQL = f"""t AS (SELECT unnest(list_transform(string_split({TITLE}, '/'), lambda x: trim(x))) AS raw FROM part),
w AS (SELECT trim({_fold_sql('raw', T.TITLE_EXPANSIONS)}) AS title FROM t)"""


@register("h8_job_titles", sql=f"WITH {_ROLES_SQL} SELECT title, count(*) AS n FROM w WHERE title <> '' GROUP BY title HAVING count(*) >= 2")
def h8(spark, sf):
    """Whole job titles used twice or more."""
    return C.job_roles(Tables(spark, sf).part.select(F.expr(TITLE).alias("title")), "title")[0]


@register("h8_title_words", sql=f"""WITH {_ROLES_SQL},
x AS (SELECT unnest({_WS.format(c='title')}) AS tok FROM w),
c AS (SELECT upper(substr(trim(tok, ','), 1, 1)) || lower(substr(trim(tok, ','), 2)) AS word FROM x)
SELECT word, count(*) AS n FROM c GROUP BY word HAVING count(*) >= 2 AND length(word) > 2""")
def h8w(spark, sf):
    """Capitalised words of the job titles, used twice or more."""
    return C.job_roles(Tables(spark, sf).part.select(F.expr(TITLE).alias("title")), "title")[1]


@register("f16_regions", sql=f"SELECT n_nationkey, replace(replace({PLACE}, 'Greater ', ''), ' Area', '') AS region FROM nation")
def f16(spark, sf):
    """Region names without 'Greater' and 'Area'."""
    return Tables(spark, sf).nation.select("n_nationkey", T.region_name(F.expr(PLACE)).alias("region"))


@register("f17_state_codes", sql=f"SELECT n_nationkey, substr('CATXNYWAOR', 1 + 2 * (n_nationkey % 5), 2) AS state FROM nation")
def f17(spark, sf):
    """State codes read off an address."""
    return Tables(spark, sf).nation.select("n_nationkey", T.state_code(F.expr(ADDRESS)).alias("state"))


@register("h9_locations_and_states", sql="""SELECT n_name AS location, CASE WHEN n_nationkey < 20 THEN substr('CATXNYWAOR', 1 + 2 * (n_nationkey % 5), 2) ELSE '???' END AS state,
  count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def h9(spark, sf):
    """Customers per place with the place's state; places above number 20 are
    not in the geocode table."""
    t = Tables(spark, sf)
    at = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.expr(PLACE).alias("place"))
    places = t.nation.where("n_nationkey < 20").select(F.col("n_name").alias("location"), F.expr(ADDRESS).alias("address"))
    return C.location_report(at, F.col("place"), places)


_PART_TITLE = "concat(p_name, ' ', lower(p_type), ' ', p_size % 8)"
_PAIRS_SQL = f"""t AS (SELECT DISTINCT {_PART_TITLE} AS t FROM part),
w AS (SELECT t, list_distinct({_WS.format(c='t')}) AS w FROM t),
d AS (SELECT a.t AS a, b.t AS b, 1.0 - len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) AS distance
      FROM w a JOIN w b ON a.t < b.t),
j AS (SELECT * FROM d WHERE distance < 0.5)"""


@register("j6_similar_titles", sql=f"WITH {_PAIRS_SQL} SELECT a, b, distance FROM j")
def j6(spark, sf):
    """Pairs of part titles at a Jaccard distance below one half."""
    return C.similar_titles(Tables(spark, sf).part.select(F.expr(_PART_TITLE).alias("t")), "t")


_CLUSTERS_SQL = f"""{_PAIRS_SQL},
c AS (SELECT a AS cluster, b AS member FROM j UNION ALL SELECT b, a FROM j
      UNION ALL SELECT DISTINCT x, x FROM (SELECT a AS x FROM j UNION SELECT b FROM j))"""


@register("c9_title_clusters", sql=f"WITH {_CLUSTERS_SQL} SELECT cluster, member FROM c")
def c9(spark, sf):
    """For each title the titles near it."""
    return C.title_clusters(Tables(spark, sf).part.select(F.expr(_PART_TITLE).alias("t")), "t")


@register("j11_contacts_of_clusters", sql=f"""WITH {_CLUSTERS_SQL}
SELECT cluster, member, count(*) AS n, min(p_partkey) AS first FROM c JOIN part ON {_PART_TITLE} = member GROUP BY ALL""")
def j11(spark, sf):
    """Parts rolled up by the clusters that their title is in."""
    p = Tables(spark, sf).part.select("p_partkey", F.expr(_PART_TITLE).alias("t"))
    rows = C.roll_up(C.title_clusters(p, "t"), p, "t", "p_partkey")
    return rows.groupBy("cluster", "member").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))


@register("c13_title_headings", sql=f"""WITH {_CLUSTERS_SQL},
x AS (SELECT cluster, unnest(list_distinct({_WS.format(c='member')})) AS word, count(*) OVER () AS z FROM c),
k AS (SELECT cluster, word, count(*) AS n FROM x GROUP BY ALL),
m AS (SELECT cluster, count(*) AS m FROM c GROUP BY ALL)
SELECT cluster, word, n / m AS share FROM k JOIN m USING (cluster) WHERE n = m""")
def c13(spark, sf):
    """The words that all titles of a cluster share: its heading."""
    c = C.title_clusters(Tables(spark, sf).part.select(F.expr(_PART_TITLE).alias("t")), "t")
    k = c.select("cluster", F.explode(F.array_distinct(T.ws_tokens("member"))).alias("word")).groupBy("cluster", "word").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    return k.join(m, "cluster").where("n = m").select("cluster", "word", (F.col("n") / F.col("m")).alias("share"))


_SKETCH_SQL = f"""t AS (SELECT DISTINCT {_PART_TITLE} AS t FROM part),
w AS (SELECT t, list_distinct({_WS.format(c='t')}) AS w FROM t),
h AS (SELECT t, w, i, list_min(list_transform(w, lambda x: md5(concat(i, ':', x)))) AS h FROM w, range(48) r(i)),
k AS (SELECT t, w, i // 2 AS band, string_agg(h, '' ORDER BY i) AS sketch FROM h GROUP BY ALL),
j AS (SELECT DISTINCT a.t AS a, b.t AS b FROM k a JOIN k b USING (band, sketch) WHERE a.t < b.t
      AND 1.0 - len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) < 0.5)"""


@register("c10_sketched_clusters", sql=f"""WITH {_SKETCH_SQL}
SELECT a AS cluster, b AS member FROM j UNION ALL SELECT b, a FROM j UNION ALL SELECT DISTINCT x, x FROM (SELECT a AS x FROM j UNION SELECT b FROM j)""")
def c10(spark, sf):
    """For each title the titles near it, compared where their sketches meet."""
    return C.sketched_clusters(Tables(spark, sf).part.select(F.expr(_PART_TITLE).alias("t")), "t")


_LEVEL_SQL = f"""WITH RECURSIVE {_PAIRS_SQL},
e AS (SELECT a, b FROM d WHERE distance <= 0.5 UNION ALL SELECT b, a FROM d WHERE distance <= 0.5),
r AS (SELECT DISTINCT a AS member, a AS seen FROM e UNION SELECT r.member, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT min(seen) AS cluster, member FROM r GROUP BY member)"""


@register("c11_level_clusters", sql=f"{_LEVEL_SQL} SELECT cluster, member FROM c")
def c11(spark, sf):
    """The clusters of part titles at level one half of single linkage."""
    return C.level_clusters(Tables(spark, sf).part.select(F.expr(_PART_TITLE).alias("t")), "t")


@register("c11_level_contacts", sql=f"""{_LEVEL_SQL}
SELECT cluster, count(DISTINCT member) AS titles, count(*) AS n FROM c JOIN part ON {_PART_TITLE} = member GROUP BY ALL""")
def c11_contacts(spark, sf):
    """Parts rolled up by the clusters of that level."""
    p = Tables(spark, sf).part.select("p_partkey", F.expr(_PART_TITLE).alias("t"))
    rows = C.roll_up(C.level_clusters(p, "t"), p, "t", "p_partkey")
    return rows.groupBy("cluster").agg(F.countDistinct("member").alias("titles"), F.count(F.lit(1)).alias("n"))


_SPOTS_SQL = """s AS (SELECT c_name, n_name, n_regionkey, n_nationkey * 3 - 30 AS lat, n_nationkey * 5 - 60 AS lon FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@register("io21_placemarks", sql=f"""WITH {_SPOTS_SQL},
n AS (SELECT *, (row_number() OVER (PARTITION BY n_name ORDER BY c_name) - 1) // 50 AS part FROM s)
SELECT n_name AS label, part, concat(lon, ',', lat) AS coords, string_agg(c_name, chr(10) ORDER BY c_name) AS contacts FROM n GROUP BY n_name, part, lat, lon
UNION ALL SELECT 'CENTROID', 0, concat(round(avg(lon), 3), ',', round(avg(lat), 3)), NULL FROM s GROUP BY n_regionkey""")
def io21(spark, sf):
    """Placemarks of the nations with their customers, fifty names a row, and
    the centroid of each region's customers."""
    t = Tables(spark, sf)
    lat, lon = F.col("n_nationkey") * 3 - 30, F.col("n_nationkey") * 5 - 60
    places = t.nation.select(F.col("n_name").alias("label"), "n_nationkey", "n_regionkey", lat.alias("lat"), lon.alias("lon"))
    people = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    means = people.groupBy("n_regionkey").agg(F.round(F.avg("lat"), 3).alias("lat"), F.round(F.avg("lon"), 3).alias("lon"))
    return C.placemarks(people, "label", "c_name", places, means, chunk=50)
