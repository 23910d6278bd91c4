"""Registered queries: XML records spelled out of the given tables and read
back as typed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.registry import register
from quarry.sources import xml as X
from quarry.sources.tables import Tables


def _opt(cond, col):
    return F.coalesce(F.when(cond, col), F.lit(""))


@register("io14_feed_entries", sql="""SELECT o_orderkey, pos, title, text FROM (
  SELECT o_orderkey, 0 AS pos, o_orderpriority AS title, concat('summary ', o_custkey) AS text FROM orders
  UNION ALL SELECT o_orderkey, 1, concat('second ', o_orderstatus), concat('description ', o_custkey) FROM orders)""")
def io14(spark, sf):
    """Entries of a stored feed per order; the second has a description only."""
    o = Tables(spark, sf).orders
    first = X.tag("item", F.concat(X.tag("title", F.col("o_orderpriority")), X.tag("summary", F.expr("concat('summary ', o_custkey)")), X.tag("description", F.lit("d"))))
    second = X.tag("item", F.concat(X.tag("title", F.expr("concat('second ', o_orderstatus)")), X.tag("description", F.expr("concat('description ', o_custkey)"))))
    xml = X.tag("rss", X.tag("channel", F.concat(first, second)))
    return X.feed_entries(o.select("o_orderkey", xml.alias("xml")), "o_orderkey", "xml")


@register("io15_property_rows", sql="""SELECT p_partkey, concat('Z', p_size) AS zipcode, p_type AS "useCode", 1900 + p_size AS "yearBuilt", p_size / 4 AS bathrooms,
  p_size % 7 AS bedrooms, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice ELSE 0.0 END AS price FROM part WHERE p_size % 5 <> 0""")
def io15(spark, sf):
    """Property records; the year is missing for each size divisible by five,
    the price for each third part."""
    p = Tables(spark, sf).part
    xml = X.tag("response", F.concat(
        X.tag("zipcode", F.expr("concat('Z', p_size)")), X.tag("useCode", F.col("p_type")), _opt(F.col("p_size") % 5 != 0, X.tag("yearBuilt", F.expr("1900 + p_size"))),
        X.tag("bathrooms", F.expr("p_size / 4")), X.tag("bedrooms", F.expr("p_size % 7")), _opt(F.col("p_partkey") % 3 != 0, X.tag("amount", F.col("p_retailprice")))))
    return X.property_rows(p.select("p_partkey", xml.alias("xml")), "p_partkey", "xml")


@register("io16_item_rows", sql="""SELECT o_custkey, o_orderkey::VARCHAR AS item_id, o_orderpriority AS title,
  CASE WHEN o_orderstatus = 'F' THEN '-1' ELSE round(o_totalprice)::BIGINT::VARCHAR END AS price, '-1' AS ends FROM orders""")
def io16(spark, sf):
    """Result lists, one per order here, with tags missing."""
    o = Tables(spark, sf).orders
    item = X.tag("Item", F.concat(X.tag("ItemId", F.col("o_orderkey")), X.tag("Title", F.col("o_orderpriority")),
                                  _opt(F.col("o_orderstatus") != "F", X.tag("CurrentPrice", F.round("o_totalprice").cast("long")))))
    return X.item_rows(o.select("o_custkey", X.tag("SearchResult", item).alias("xml")), "o_custkey", "xml")


@register("io17_attribute_vectors", sql="""SELECT p_partkey, [p_size::DOUBLE, p_retailprice] AS vec FROM part WHERE p_size % 4 <> 0""")
def io17(spark, sf):
    """Attribute lists as vectors; the size is missing for some parts."""
    p = Tables(spark, sf).part
    attr = lambda i, v: X.tag("Attribute", F.concat(X.tag("id", F.lit(i)), X.tag("value", v)))
    xml = X.tag("Item", F.concat(attr("26444", F.col("p_retailprice")), attr("1", F.col("p_name")), _opt(F.col("p_size") % 4 != 0, attr("25710", F.col("p_size")))))
    return X.attribute_vectors(p.select("p_partkey", xml.alias("xml")), "p_partkey", "xml", ["25710", "26444"])


@register("io25_user_profiles", sql="""SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS sex, c_mktsegment AS status,
  concat('City', c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN ', ST' ELSE '' END) AS location,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('College ', c_nationkey) END AS college,
  CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN '0' ELSE '1999' END AS year FROM customer""")
def io25(spark, sf):
    """User profiles with optional states, colleges and years."""
    c = Tables(spark, sf).customer
    aff = lambda kind, name, year: X.tag("affiliations", F.concat(X.tag("type", F.lit(kind)), X.tag("name", name), year))
    key = F.col("c_custkey")
    college = aff("1", F.expr("concat('College ', c_nationkey)"), _opt(key % 7 != 0, X.tag("year", F.lit("1999"))))
    xml = X.tag("user", F.concat(
        X.tag("name", F.col("c_name")), X.tag("sex", F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END")), X.tag("status", F.col("c_mktsegment")),
        X.tag("hometown", F.concat(X.tag("city", F.expr("concat('City', c_nationkey)")), _opt(key % 3 == 0, X.tag("state", F.lit("ST"))))),
        aff("2", F.lit("Work"), F.lit("")), F.when(key % 5 != 0, F.concat(aff("1", F.lit("First"), F.lit("")), college)).otherwise(F.lit(""))))
    return X.user_profiles(c.select("c_custkey", xml.alias("xml")), "c_custkey", "xml")
