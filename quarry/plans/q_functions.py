"""Registered queries: scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions import vectors as V
from quarry.operators import knn as N
from quarry.operators import relational as Rel
from quarry.plans.registry import register
from quarry.sources.tables import Tables


@register("f23_date_parts", sql="""SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
day(o_orderdate) AS day, hour(o_orderdate) AS hour FROM orders""")
def f23(spark, sf):
    """Year, month, day and hour of every order date."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.dayofmonth("o_orderdate").alias("day"), F.hour("o_orderdate").alias("hour"))


@register("f6_clean_pages", sql=r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(html,
  '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
  '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' ', 'g'), '  ', ' ', 'g'), '  ', ' ', 'g'))) AS text_md5 FROM pages""")
def f6(spark, sf):
    """Whole pages cleaned (script, style, comments, tags, nbsp, double
    spaces), as a digest of the text."""
    p = Tables(spark, sf).pages
    return p.select("page_id", F.md5(T.clean_html("html").cast("binary")).alias("text_md5"))


@register("f7_decoded_pages", sql=r"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g')) AS text_md5 FROM pages""")
def f7(spark, sf):
    """Whole pages with character references decoded, as a digest.  The oracle
    states the references that the given pages hold; all others are tested
    against the standard library."""
    p = Tables(spark, sf).pages
    return p.select("page_id", F.md5(T.html_unescape("html").cast("binary")).alias("text_md5"))


_STRIP_SQL = "regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '<[^>]*$', ''), '>', ' ', 'g')"


@register("f5_strip_tags", sql=f"SELECT page_id, md5({_STRIP_SQL}) AS text_md5 FROM pages")
def f5(spark, sf):
    """Pages without tags, as a digest."""
    return Tables(spark, sf).pages.select("page_id", F.md5(T.strip_tags("html").cast("binary")).alias("text_md5"))


_ITEM = "concat('My New ', p_name, CASE WHEN p_size % 2 = 0 THEN ' & more.' ELSE '!' END)"


@register("f10_item_names", sql=f"""SELECT p_partkey, CASE WHEN length(n) >= 2 THEN n END AS item FROM (
  SELECT p_partkey, array_to_string(list_filter(string_split(trim(regexp_replace(lower({_ITEM}), '[!-.&]', '', 'g')), ' '),
    lambda x: x NOT IN ({", ".join(f"'{w}'" for w in T.ITEM_STOP_WORDS)})), ' ') AS n FROM part)""")
def f10(spark, sf):
    """Item names normalised."""
    return Tables(spark, sf).part.select("p_partkey", T.item_name(F.expr(_ITEM)).alias("item"))


@register("f24_minutes", sql="SELECT event_id, hour(ts) * 60 + minute(ts) AS minutes FROM events")
def f24(spark, sf):
    """H:MM times as minutes of the day."""
    return Tables(spark, sf).events.select("event_id", T.hm_minutes(F.date_format("ts", "H:mm")).alias("minutes"))


_LINE = """concat(year(o_orderdate), ',', CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE '' END, ',skiing:', lower(o_orderstatus), ':opera,',
  month(o_orderdate), ',', CASE WHEN o_totalprice > 200000 THEN 'yes' ELSE 'no' END, ',opera:f:opera,', o_custkey % 90, ',', o_custkey % 180, ',', o_orderkey % 90, ',', o_orderkey % 180)"""


def _pair_fields(spark, sf):
    """Ten fields of a comma-separated pair row."""
    o = Tables(spark, sf).orders.select("o_orderkey", F.split(F.expr(_LINE), ",").alias("f"))
    return o, [F.col("f")[i] for i in range(10)]


_INTERESTS = """CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END"""


@register("p12_b15_pair_features", sql=f"""SELECT o_orderkey, year(o_orderdate) AS age1, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS yes1,
  month(o_orderdate) AS age2, CASE WHEN o_totalprice > 200000 THEN 1 ELSE -1 END AS yes2, {_INTERESTS} AS overlap,
  sqrt((69.1::DOUBLE * (o_orderkey % 90 - o_custkey % 90)) ** 2 + (53.0::DOUBLE * (o_orderkey % 180 - o_custkey % 180)) ** 2) AS miles FROM orders""")
def p12(spark, sf):
    """Numeric features of a mixed-type pair row: ages, yes / no codes,
    interest overlap and distance, picked by position."""
    o, f = _pair_fields(spark, sf)
    return o.select("o_orderkey", f[0].cast("int").alias("age1"), T.yes_no(f[1]).alias("yes1"), f[3].cast("int").alias("age2"), T.yes_no(f[4]).alias("yes2"),
                    T.interest_overlap(f[2], f[5]).alias("overlap"),
                    T.miles(f[6].cast("double"), f[7].cast("double"), f[8].cast("double"), f[9].cast("double")).alias("miles"))


@register("f25_yes_no", sql="SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS code FROM orders")
def f25(spark, sf):
    """Yes / no answers coded."""
    o, f = _pair_fields(spark, sf)
    return o.select("o_orderkey", T.yes_no(f[1]).alias("code"))


@register("f26_interest_overlap", sql=f"SELECT o_orderkey, {_INTERESTS} AS overlap FROM orders")
def f26(spark, sf):
    """Interests of one list that the other has."""
    o, f = _pair_fields(spark, sf)
    return o.select("o_orderkey", T.interest_overlap(f[2], f[5]).alias("overlap"))


@register("f27_miles", sql="""SELECT o_orderkey, sqrt(pow(69.1::DOUBLE * (o_orderkey % 90 - o_custkey % 90), 2) + pow(53.0::DOUBLE * (o_orderkey % 180 - o_custkey % 180), 2)) AS miles FROM orders""")
def f27(spark, sf):
    """Flat-earth miles between two places."""
    o, f = _pair_fields(spark, sf)
    return o.select("o_orderkey", T.miles(*[f[i].cast("double") for i in (6, 7, 8, 9)]).alias("miles"))


@register("f32_wine_price", sql="""SELECT p_partkey, greatest(CASE WHEN age > peak THEN rating / 2 * (5 - (age - peak) / 2) ELSE rating / 2 * (5 * ((age + 1) / peak)) END, 0.0::DOUBLE) AS price
FROM (SELECT p_partkey, 51.0::DOUBLE + p_size AS rating, 1.0::DOUBLE + p_size AS peak, (p_partkey % 50)::DOUBLE AS age FROM part)""")
def f32(spark, sf):
    """Wine prices by rating and age."""
    p = Tables(spark, sf).part.select("p_partkey", (F.lit(51.0) + F.col("p_size")).alias("rating"), (F.col("p_partkey") % 50).cast("double").alias("age"))
    return p.select("p_partkey", N.wine_price("rating", "age").alias("price"))


@register("f33_tanh", sql="SELECT event_id, tanh(value / 100) AS y, 1.0 - tanh(value / 100) * tanh(value / 100) AS dy FROM events")
def f33(spark, sf):
    """tanh and its derivative."""
    e = Tables(spark, sf).events.select("event_id", V.tanh(F.col("value") / 100).alias("y"))
    return e.select("event_id", "y", V.dtanh("y").alias("dy"))


@register("f35_jaccard_distance", sql=r"""SELECT p_partkey, 1.0 - len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS distance FROM (
  SELECT p_partkey, list_distinct(string_split(lower(concat(p_name, ' ', p_type)), ' ')) AS a, list_distinct(string_split(lower(concat('small ', p_type, ' ring')), ' ')) AS b FROM part)""")
def f35(spark, sf):
    """Jaccard distance of two word sets of every part."""
    a, b = F.expr("lower(concat(p_name, ' ', p_type))"), F.expr("lower(concat('small ', p_type, ' ring'))")
    return Tables(spark, sf).part.select("p_partkey", T.jaccard_distance(T.ws_tokens(a), T.ws_tokens(b)).alias("distance"))


@register("f39_entry_text", sql="SELECT doc_id, md5(concat(source, chr(10), lang, chr(10), text)) AS text_md5 FROM documents")
def f39(spark, sf):
    """Publisher, title and summary as one text, as a digest."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.md5(T.entry_text("source", "lang", "text").cast("binary")).alias("text_md5"))


_KEEP = r"list_filter(regexp_split_to_array({c}, '\s+'), lambda x: length(x) > 2 AND length(x) < 20)"


@register("f38_entry_features", sql=f"""WITH s AS (SELECT conv_id, turn, role, {_KEEP.format(c='text')} AS raw FROM conversations),
w AS (SELECT *, list_transform(raw, lambda x: lower(x)) AS sw, len(list_filter(raw, lambda x: x = upper(x) AND x <> lower(x))) AS up FROM s)
SELECT conv_id, turn, unnest(list_distinct(list_concat(list_concat(list_concat(['Title:' || 'turn', 'Publisher:' || role], sw),
  list_transform(range(1, len(sw)), lambda i: sw[i] || ' ' || sw[i + 1])), CASE WHEN len(sw) > 0 AND up / len(sw) > 0.3 THEN ['UPPERCASE'] ELSE [] END))) AS feature FROM w""")
def f38(spark, sf):
    """Classifier features of an entry: title and summary words, word pairs,
    publisher, and whether it shouts."""
    c = Tables(spark, sf).conversations
    return c.select("conv_id", "turn", F.explode(T.entry_features(F.lit("turn"), F.col("text"), F.col("role"))).alias("feature"))


_GEO = """concat('<p>x</p><span class="geo">', CASE WHEN s_suppkey % 2 = 0 THEN concat(s_nationkey - 12, '.5; ', s_suppkey % 180, '.25')
  ELSE concat('<abbr class="latitude">', s_nationkey - 12, '.5</abbr> <abbr class="longitude">', s_suppkey % 180, '.25</abbr>') END, '</span>')"""


@register("f37_geo", sql="""SELECT s_suppkey, concat(s_nationkey - 12, '.5')::DOUBLE AS latitude, concat(s_suppkey % 180, '.25')::DOUBLE AS longitude FROM supplier""")
def f37(spark, sf):
    """Coordinates out of the geo microformat in both its forms."""
    lat, lon = T.geo(F.expr(_GEO))
    return Tables(spark, sf).supplier.select("s_suppkey", lat.alias("latitude"), lon.alias("longitude"))


@register("p7_notes", sql=r"""SELECT conv_id, turn, md5(trim(replace(replace(regexp_replace(text, '(?s)<[^>]*>', ' ', 'g'), '  ', ' '), '  ', ' '))) AS text_md5
FROM conversations WHERE role = 'user' AND trim(text) <> ''""")
def p7(spark, sf):
    """Entries of one type that have a text, cleaned, as a digest."""
    c = Tables(spark, sf).conversations
    kept = c.where((F.col("role") == "user") & (F.trim("text") != ""))
    return kept.select("conv_id", "turn", F.md5(T.clean_html("text").cast("binary")).alias("text_md5"))


@register("w4_runs", sql=r"""WITH t AS (SELECT conv_id, turn, unnest(ws) AS w, unnest(range(0, len(ws))) AS p FROM (
  SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws FROM conversations)),
c AS (SELECT *, p - row_number() OVER (PARTITION BY conv_id, turn ORDER BY p) AS g FROM t WHERE w = upper(w) OR substr(w, 1, 1) <> lower(substr(w, 1, 1)))
SELECT conv_id, turn, min(p) AS first, string_agg(w, ' ' ORDER BY p) AS phrase FROM c GROUP BY conv_id, turn, g HAVING count(*) > 1""")
def w4(spark, sf):
    """Runs of two or more neighbouring words of one tag (here: capitalised),
    as phrases.  Words of other tags never leave their row."""
    c = Tables(spark, sf).conversations
    words = F.transform(T.ws_tokens("text"), lambda w, i: F.struct(i.alias("p"), w.alias("w")))
    tag = lambda x: (x["w"] == F.upper(x["w"])) | (F.substring(x["w"], 1, 1) != F.lower(F.substring(x["w"], 1, 1)))
    t = c.select("conv_id", "turn", F.explode(F.filter(words, tag)).alias("x")).select("conv_id", "turn", "x.p", "x.w")
    runs = Rel.islands(t, ["conv_id", "turn"], "p", 2).groupBy("conv_id", "turn", "island").agg(
        F.min("p").alias("first"), F.array_sort(F.collect_list(F.struct("p", "w"))).alias("ws"))
    return runs.where(F.size("ws") > 1).select("conv_id", "turn", "first", F.array_join(F.transform("ws", lambda x: x["w"]), " ").alias("phrase"))
