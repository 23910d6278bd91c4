"""Registered queries: file formats.  Each writes a given table in the format
and reads it back through the loader."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.operators import text_mining as X
from quarry.plans.q_classify import _BASE_SQL, _train
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import files as IO
from quarry.sources.tables import PART_EDGES_SQL, Tables


def _path(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("io1_ratings", sql="""SELECT o_custkey::VARCHAR AS user_id, p_name || ' ' || p_partkey AS item, l_quantity AS rating, l_orderkey AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
def io1(spark, sf):
    """Ratings by item title from an item file and a ratings file."""
    t = Tables(spark, sf)
    items, data = _path(spark, "items"), _path(spark, "ratings")
    t.part.select("p_partkey", F.expr("p_name || ' ' || p_partkey"), "p_type", "p_size").write.option("sep", "|").csv(items)
    (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey", "l_quantity", "l_orderkey")
     .write.option("sep", "\t").csv(data))
    return IO.read_ratings(spark, items, data)


@register("io2_io3_count_matrix", sql="""SELECT o_custkey::VARCHAR AS row, col, value FROM (
  SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1)
  UNPIVOT (value FOR col IN (F, O, P))""")
def io2(spark, sf):
    """A dense tab matrix of order counts, customer by status, written and read
    in long form."""
    o = Tables(spark, sf).orders
    counts = o.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    path = _path(spark, "matrix")
    IO.write_count_matrix(counts, "o_custkey", "o_orderstatus", "n", ["F", "O", "P"], path)
    return IO.read_labelled_matrix(spark, path).select("row", "col", F.col("value").cast("long").alias("value"))


@register("io4_ownership_matrix", sql="""WITH w AS (SELECT DISTINCT o_custkey, p_type FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey),
t AS (SELECT p_type FROM w GROUP BY 1 HAVING count(DISTINCT o_custkey) > 10), c AS (SELECT DISTINCT o_custkey FROM w JOIN t USING (p_type))
SELECT t.p_type AS row, o_custkey::VARCHAR AS col, (w.o_custkey IS NOT NULL)::INT AS value FROM t CROSS JOIN c LEFT JOIN w USING (o_custkey, p_type)""")
def io4(spark, sf):
    """0/1 ownership of part types with more than ten owners by all customers
    that own one, written in tiles and read back."""
    t = Tables(spark, sf)
    w = (t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
         .select("o_custkey", "p_type").distinct())
    wide = w.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).where("n > 10").select("p_type")
    path = _path(spark, "owners")
    IO.write_ownership_matrix(w.join(wide, "p_type"), "p_type", "o_custkey", path)
    return IO.read_ownership_matrix(spark, path)


@register("io5_labelled_csv", sql="SELECT p_size::DOUBLE AS a, p_retailprice AS b, (p_size > 25)::INT AS match FROM part")
def io5(spark, sf):
    """Comma rows of numbers with a label at the end."""
    path = _path(spark, "labelled")
    Tables(spark, sf).part.select("p_size", "p_retailprice", (F.col("p_size") > 25).cast("int")).write.csv(path)
    return IO.read_labelled_csv(spark, path, 2).select(F.col("data")[0].alias("a"), F.col("data")[1].alias("b"), "match")


@register("io6_contacts", sql="""SELECT c_name AS "Name", concat('é ', c_mktsegment) AS "Title" FROM customer""")
def io6(spark, sf):
    """Contacts in a UTF-16 tab file with a header."""
    path = _path(spark, "contacts")
    (Tables(spark, sf).customer.select(F.col("c_name").alias("Name"), F.expr("concat('é ', c_mktsegment)").alias("Title"))
     .write.option("sep", "\t").option("header", True).option("encoding", "UTF-16").csv(path))
    return IO.read_contacts(spark, path)


@register("io7_schedule", sql="""SELECT l_returnflag AS origin, l_linestatus AS dest, strftime(l_shipdate, '%-H:%M') AS depart, '9:00' AS arrive, l_quantity::INT AS price,
  count(*) AS n FROM lineitem GROUP BY ALL""")
def io7(spark, sf):
    """A schedule file with leg numbers per route (counted by leg-free rows, as
    the order of equal legs is the file's)."""
    path = _path(spark, "schedule")
    (Tables(spark, sf).lineitem.select("l_returnflag", "l_linestatus", F.date_format("l_shipdate", "H:mm"), F.lit("9:00"), F.col("l_quantity").cast("int")).write.csv(path))
    s = IO.read_schedule(spark, path)
    return s.groupBy("origin", "dest", "depart", "arrive", "price").agg(F.count("leg").alias("n"))


@register("io8_io9_json_documents", sql="SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def io8(spark, sf):
    """Documents as JSON, written and read with a schema."""
    path = _path(spark, "json")
    IO.write_json(Tables(spark, sf).documents.select("doc_id", "lang", "text"), path)
    back = spark.read.schema("doc_id long, lang string, text string").json(path)
    return back.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@register("io10_s8_document_store", sql="SELECT event_id, event_type FROM events WHERE value > 20 AND event_type <> 'view'")
def io10(spark, sf):
    """Batches appended to a document store, then read by criteria and fields."""
    e = Tables(spark, sf).events
    path = _path(spark, "store")
    for kind in ("click", "error", "purchase", "signup", "view"):
        IO.save_documents(e.where(F.col("event_type") == kind), path)
    return IO.load_documents(spark, path, (F.col("value") > 20) & (F.col("event_type") != "view"), ["event_id", "event_type"])


@register("io18_graph_snapshot", sql=f"WITH {PART_EDGES_SQL} SELECT src, dst FROM part_edges")
def io18(spark, sf):
    """The part graph saved and restored."""
    path = _path(spark, "graph")
    IO.save_table(Tables(spark, sf).part_edges(), path)
    return spark.read.parquet(path)


@register("io19_node_link", sql=f"""WITH {PART_EDGES_SQL}, e AS (SELECT DISTINCT src, dst FROM part_edges),
v AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM (SELECT src AS id FROM e UNION SELECT dst FROM e))
SELECT a.idx AS source, b.idx AS target FROM e JOIN v a ON a.id = src JOIN v b ON b.id = dst""")
def io19(spark, sf):
    """Links of the part graph by dense node numbers."""
    return G.node_link(Tables(spark, sf).part_edges().distinct())[1]


@register("io20_hierarchy", sql="""WITH g AS (SELECT DISTINCT substr(p_type || ' parts of the catalogue', 1, 30) AS name, p_name || ' ' || p_partkey AS child FROM part),
r AS (SELECT *, (row_number() OVER (PARTITION BY name ORDER BY child) - 1) // 1000 AS part FROM g)
SELECT name, part, '{"name":"' || name || '","children":[' || string_agg('{"name":"' || child || '"}', ',' ORDER BY child) || ']}' AS json FROM r GROUP BY name, part""")
def io20(spark, sf):
    """Part types and their parts as hierarchy objects of bounded size."""
    p = Tables(spark, sf).part.select(F.expr("p_type || ' parts of the catalogue'").alias("label"), F.expr("p_name || ' ' || p_partkey").alias("member"))
    return IO.hierarchy_json(p, "label", "member")


@register("io22_classifier_state", sql=f"WITH {_BASE_SQL} SELECT feature, cat, n FROM fc")
def io22(spark, sf):
    """Classifier counts saved and restored."""
    path = _path(spark, "classifier")
    IO.save_table(_train(spark, sf)[0], path)
    return spark.read.parquet(path)


@register("io24_marked_up", sql="SELECT doc_id, md5(replace(replace(text, 'que', '<strong>que</strong>'), 'und', '<strong>und</strong>')) AS text_md5 FROM documents")
def io24(spark, sf):
    """Documents with chosen terms marked, as a digest."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.md5(X.mark_up(F.col("text"), F.array(F.lit("que"), F.lit("und"))).cast("binary")).alias("text_md5"))
