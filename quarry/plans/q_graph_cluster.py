"""Registered queries: graph metrics on the part graph and clustering of the
embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.operators import cliques as CQ
from quarry.operators import cluster as CL
from quarry.operators import graph as G
from quarry.operators import scaling as SC
from quarry.operators.classify import class_means
from quarry.plans.registry import register
from quarry.session import cut_lineage
from quarry.sources.tables import PART_EDGES_SQL, PREFS_SQL, Tables

SEED_PART = 558


def _edges(spark, sf):
    return Tables(spark, sf).part_edges()


@register("g3_degree_centrality", sql=f"""WITH {PART_EDGES_SQL},
e AS (SELECT DISTINCT src, dst FROM part_edges),
v AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
ends AS (SELECT src AS id FROM e UNION ALL SELECT dst FROM e)
SELECT id, count(*) / ((SELECT count(*) FROM v) - 1) AS centrality FROM ends GROUP BY id""")
def g3(spark, sf):
    """In + out degree over (n - 1) for every part of the directed part graph."""
    return G.degree_centrality(_edges(spark, sf), directed=True)


@register("g2_out_neighbours", sql=f"""WITH {PART_EDGES_SQL}
SELECT DISTINCT dst AS id FROM part_edges WHERE src = {SEED_PART}""")
def g2(spark, sf):
    """Out-neighbours of one part."""
    return G.neighbours(_edges(spark, sf), SEED_PART, "out")


@register("g12_crawl_levels", sql=f"""WITH {PART_EDGES_SQL},
e AS (SELECT DISTINCT src, dst FROM part_edges),
l0 AS (SELECT {SEED_PART}::BIGINT AS id, 0 AS dist),
l1 AS (SELECT DISTINCT dst AS id, 1 AS dist FROM e WHERE src IN (SELECT id FROM l0) AND dst NOT IN (SELECT id FROM l0)),
s1 AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1),
l2 AS (SELECT DISTINCT dst AS id, 2 AS dist FROM e WHERE src IN (SELECT id FROM l1) AND dst NOT IN (SELECT id FROM s1))
SELECT {SEED_PART}::BIGINT AS source, id, dist FROM s1 UNION ALL SELECT {SEED_PART}::BIGINT, id, dist FROM l2""")
def g12(spark, sf):
    """Parts reachable from one part within two hops, with their hop count."""
    src = spark.createDataFrame([(SEED_PART,)], "id long")
    return G.bfs_levels(_edges(spark, sf), src, max_depth=2)


@register("g6_attributes_through_edges", sql=f"""WITH {PART_EDGES_SQL}
SELECT DISTINCT p.p_brand, p.p_type FROM part_edges e JOIN part p ON e.dst = p.p_partkey WHERE e.src = {SEED_PART}""")
def g6(spark, sf):
    """Brands and types of the parts one part links to."""
    t = Tables(spark, sf)
    n = G.neighbours(t.part_edges(), SEED_PART, "out")
    p = t.part
    return n.join(p, n.id == p.p_partkey).select("p_brand", "p_type").distinct()


@register("g7_derived_edges", sql="""SELECT DISTINCT 'buys_brand' AS type, o_custkey::VARCHAR AS src, p_brand AS dst
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
UNION SELECT DISTINCT 'brand_has_part', p_brand, p_partkey::VARCHAR FROM part""")
def g7(spark, sf):
    """Typed derived edges: customer buys brand, brand has part."""
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    p = t.part.select("p_partkey", "p_brand")
    a = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
         .select(F.lit("buys_brand").alias("type"), F.col("o_custkey").cast("string").alias("src"),
                 F.col("p_brand").alias("dst")))
    b = p.select(F.lit("brand_has_part").alias("type"), F.col("p_brand").alias("src"),
                 F.col("p_partkey").cast("string").alias("dst"))
    return a.unionByName(b).distinct()


_VL = """vl AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
q AS (SELECT pos, avg(x) AS qx FROM vl WHERE label = 0 GROUP BY 1)"""


def _q(spark, sf):
    e = Tables(spark, sf).embeddings
    return e, class_means(e.where(F.col("label") == 0), "embedding", "label")[0]


@register("c1_pearson_distance", sql=f"""WITH {_VL},
s AS (SELECT vl.vec_id, count(*) AS n, sum(x) AS s1, sum(qx) AS s2, sum(x*x) AS q1, sum(qx*qx) AS q2, sum(x*qx) AS p
      FROM vl JOIN q USING (pos) GROUP BY 1),
r AS (SELECT vec_id, p - s1*s2/n AS num, sqrt(greatest((q1 - s1*s1/n) * (q2 - s2*s2/n), 0.0)) AS den FROM s)
SELECT vec_id, round(CASE WHEN den = 0 THEN 0.0 ELSE 1.0 - num / den END, 9) AS distance FROM r""")
def c1(spark, sf):
    """Pearson distance of every vector to the class-0 mean vector."""
    e, q = _q(spark, sf)
    return e.select("vec_id", F.round(V.pearson_distance("embedding", V.lit_vector(q)), 9).alias("distance"))


@register("c2_tanimoto_distance", sql=f"""WITH {_VL},
s AS (SELECT vl.vec_id, count(*) FILTER (WHERE x <> 0) AS c1, count(*) FILTER (WHERE qx > 0.01) AS c2,
        count(*) FILTER (WHERE x <> 0 AND qx > 0.01) AS sh FROM vl JOIN q USING (pos) GROUP BY 1)
SELECT vec_id, 1.0 - sh / nullif(c1 + c2 - sh, 0) AS distance FROM s""")
def c2(spark, sf):
    """Tanimoto distance between each vector's non-zero mask and the mask of
    class-0 mean components above 0.01."""
    e, q = _q(spark, sf)
    mask = [1.0 if x > 0.01 else 0.0 for x in q]
    return e.select("vec_id", V.tanimoto("embedding", V.lit_vector(mask)).alias("distance"))


@register("c4_rotate", sql="""SELECT unnest(range(0, len(embedding))) AS "row", unnest(embedding)::DOUBLE AS x, vec_id AS col
FROM embeddings""")
def c4(spark, sf):
    """Transposed embedding matrix in long form."""
    return CL.rotate(Tables(spark, sf).embeddings, "vec_id", "embedding")


@register("c5_kmeans")
def c5(spark, sf):
    """K-means (k = 4, Pearson distance) of the embeddings."""
    a, _ = CL.kmeans(Tables(spark, sf).embeddings, "vec_id", "embedding", k=4, distance="pearson")
    return a


@register("c5_kmeans_euclidean")
def c5e(spark, sf):
    """K-means (k = 10, Euclidean distance) of the embeddings."""
    a, _ = CL.kmeans(Tables(spark, sf).embeddings, "vec_id", "embedding", k=10, distance="euclidean")
    return a


@register("g1_interest_graph", sql=f"""WITH {PREFS_SQL}, e AS (SELECT src, dst FROM (
  SELECT user_id::VARCHAR AS src, item_id::VARCHAR AS dst, row_number() OVER (PARTITION BY user_id ORDER BY item_id::VARCHAR) AS r FROM prefs) WHERE r <= 500)
SELECT 'likes' AS kind, src AS id, dst AS other FROM e UNION ALL SELECT DISTINCT 'user', src, '' FROM e UNION ALL SELECT DISTINCT 'item', dst, '' FROM e""")
def g1(spark, sf):
    """Typed nodes and edges of customers and the parts they bought."""
    nodes, edges = G.interest_graph(Tables(spark, sf).prefs(), "user_id", "item_id")
    return (edges.select(F.col("type").alias("kind"), F.col("src").alias("id"), F.col("dst").alias("other"))
            .unionByName(nodes.select(F.col("type").alias("kind"), "id", F.lit("").alias("other"))))


@register("g8_mutual_friends", sql=f"""WITH {PART_EDGES_SQL},
u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM part_edges WHERE src <> dst),
x AS (SELECT a, b FROM u UNION ALL SELECT b, a FROM u), m AS (SELECT b AS f FROM x WHERE a = {SEED_PART})
SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM (
  SELECT {SEED_PART} AS src, f AS dst FROM m UNION ALL SELECT x.a, x.b FROM x JOIN m p ON p.f = x.a JOIN m q ON q.f = x.b)""")
def g8(spark, sf):
    """One part, its neighbours, and the edges among them."""
    return G.mutual_friend_edges(SEED_PART, G.mutual_friends(_edges(spark, sf), SEED_PART))


@register("c12_location_clusters")
def c12(spark, sf):
    """Places (nations, at coordinates made of their numbers) in three clusters,
    weighted by their customers."""
    t = Tables(spark, sf)
    n = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("freq"))
    at = n.select("c_nationkey", (F.col("c_nationkey") % 5 * 10.0).alias("lon"), (F.col("c_nationkey") % 7 * 5.0).alias("lat"), "freq")
    return CL.weighted_kmeans(at, ["lon", "lat"], "freq")[0].select("c_nationkey", "cluster")


@register("g5_closeness")
def g5(spark, sf):
    """Closeness of every part of the undirected part graph, by counters of
    1,024 registers (3 % error)."""
    return G.closeness_centrality(_edges(spark, sf), lg_k=10)


@register("g4_betweenness")
def g4(spark, sf):
    """Betweenness of every part from the shortest paths of 64 sources."""
    return G.betweenness_centrality(_edges(spark, sf), n_sources=64, batch=32)


@register("c8_landmark_scaling")
def c8(spark, sf):
    """Two coordinates for every vector."""
    placed = SC.landmark_scaling(Tables(spark, sf).embeddings, "vec_id", "embedding")
    return placed.select(F.col("id").alias("vec_id"), F.round(F.col("place")[0], 6).alias("x"), F.round(F.col("place")[1], 6).alias("y"))


def _cliques_sql(edges: str) -> str:
    """Every clique grown by rising ids; ``common`` are the neighbours that all
    its members share, so a maximal one has none left."""
    return f"""WITH RECURSIVE {PART_EDGES_SQL}, {edges},
b AS (SELECT a AS id, b AS nb FROM u UNION SELECT b, a FROM u),
adj AS (SELECT id, list(nb) AS nb FROM b GROUP BY id),
c AS (SELECT [id] AS members, nb AS common FROM adj UNION ALL
      SELECT list_append(members, x), list_intersect(common, nb) FROM (
        SELECT members, common, unnest(list_filter(common, lambda y: y > members[-1])) AS x FROM c) g JOIN adj ON adj.id = g.x),
k AS (SELECT members FROM c WHERE len(common) = 0)"""


_ALL_SQL = "u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM part_edges WHERE src <> dst)"
_MUTUAL_SQL = f"""p AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM part_edges WHERE src <> dst),
m AS (SELECT b AS f FROM p WHERE a = {SEED_PART} UNION SELECT a FROM p WHERE b = {SEED_PART}),
u AS (SELECT a, b FROM p WHERE (a = {SEED_PART} OR a IN (SELECT f FROM m)) AND (b = {SEED_PART} OR b IN (SELECT f FROM m)))"""
_STATISTICS_SQL = """s AS (SELECT members, len(members) AS size FROM k),
z AS (SELECT count(*) AS n_cliques, floor(avg(size))::BIGINT AS mean_size, max(size) AS largest FROM s),
l AS (SELECT members FROM s, z WHERE size = largest),
x AS (SELECT m FROM (SELECT unnest(members) AS m FROM l) GROUP BY m HAVING count(*) = (SELECT count(*) FROM l))
SELECT n_cliques, mean_size, largest, (SELECT count(*) FROM l) AS n_largest,
  coalesce((SELECT string_agg(m::VARCHAR, ',' ORDER BY m) FROM x), '') AS in_all_largest FROM z"""


def _joined(report):
    return report.withColumn("in_all_largest", F.array_join("in_all_largest", ","))


@register("g9_maximal_cliques", sql=f"{_cliques_sql(_ALL_SQL)} SELECT array_to_string(members, ',') AS members, len(members) AS size FROM k")
def g9(spark, sf):
    """Every maximal clique of the part graph."""
    return CQ.maximal_cliques(_edges(spark, sf)).select(F.array_join("members", ",").alias("members"), F.size("members").alias("size"))


@register("g10_clique_statistics", sql=f"{_cliques_sql(_ALL_SQL)}, {_STATISTICS_SQL}")
def g10(spark, sf):
    """Number, mean and largest size of the cliques of the part graph, and who
    is in all the largest."""
    return _joined(CQ.clique_statistics(cut_lineage(CQ.maximal_cliques(_edges(spark, sf)))))


@register("h12_mutual_cliques", sql=f"{_cliques_sql(_MUTUAL_SQL)}, {_STATISTICS_SQL}")
def h12(spark, sf):
    """The clique report of one part and its mutual neighbours."""
    e = _edges(spark, sf)
    return _joined(CQ.clique_statistics(cut_lineage(CQ.maximal_cliques(G.mutual_friend_edges(SEED_PART, G.mutual_friends(e, SEED_PART))))))
