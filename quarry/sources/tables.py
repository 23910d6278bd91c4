"""Driver tables and the long-form views derived from them.

The driver data is a star schema plus text tables, one parquet file each.
The operators of quarry work on long tables with explicit schemas; this
module maps the driver tables onto those shapes:

* preferences ``(user_id, item_id, rating)`` from orders x lineitem,
* directed part edges ``(src, dst)`` from consecutive line items,
* word tokens ``(doc_id, pos, word)`` of documents.

Each view is a lazy DataFrame, so Catalyst prunes columns and pushes filters
into the parquet scans.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as T

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()

# A caller that reads files of a single row group (one scan task each) may set
# this to a number of partitions; unset, scans keep the splits of their files.
SPREAD_CONF = "spark.quarry.scan.spread"


class Tables:
    """Lazy access to the driver tables of one scale factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            path = os.path.join(self.sf_dir, f"{name}.parquet")
            df = self.spark.read.parquet(path)
            spread = int(self.spark.conf.get(SPREAD_CONF, "0"))
            return df.repartition(spread) if spread else df
        raise AttributeError(name)

    # ---- derived long views -------------------------------------------------

    def prefs(self) -> DataFrame:
        """Ratings: user = customer, item = part, rating = mean quantity."""
        o = self.orders.select("o_orderkey", "o_custkey")
        li = self.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .groupBy(F.col("o_custkey").alias("user_id"),
                         F.col("l_partkey").alias("item_id"))
                .agg(F.avg("l_quantity").alias("rating")))

    def part_edges(self) -> DataFrame:
        """Directed edges between parts of consecutive lines of an order.

        The window is partitioned by order, so one shuffle on l_orderkey;
        duplicates are kept (link tables count them).  Line numbers repeat
        within an order, so part and supplier keys break the ties."""
        w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
        li = self.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return (li.select(F.lag("l_partkey").over(w).alias("src"),
                          F.col("l_partkey").alias("dst"))
                .where(F.col("src").isNotNull()))

    def doc_tokens(self, keep_empty: bool = False) -> DataFrame:
        """(doc_id, pos, word): lower-case non-empty words, 0-based position."""
        d = self.documents.select("doc_id", "text")
        return d.select("doc_id", F.posexplode(T.words(F.col("text"))).alias("pos", "word"))


# SQL forms of the same views, for the DuckDB oracle strings.
PREFS_SQL = """prefs AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, avg(l.l_quantity) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2)"""

PART_EDGES_SQL = """part_edges AS (
  SELECT * FROM (
    SELECT lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS src,
           l_partkey AS dst
    FROM lineitem) e
  WHERE src IS NOT NULL)"""

DOC_TOKENS_SQL = r"""doc_tokens AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos
  FROM (SELECT doc_id,
               list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda x: x <> '') AS ws
        FROM documents) d)"""
