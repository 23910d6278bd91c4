"""Registered queries: similarity and recommendation over orders x lineitem."""

from __future__ import annotations

from quarry.operators import recommend as R
from quarry.plans.registry import register
from quarry.session import cut_lineage
from quarry.sources.tables import PREFS_SQL, Tables

PERSON = 7          # the customer the single-person reports are about
N_SIMILAR = 10      # neighbours kept per item (R6)

_PAIR_SUMS_SQL = """
  count(*) AS n, sum(ra) AS s1, sum(rb) AS s2, sum(ra*ra) AS q1, sum(rb*rb) AS q2,
  sum(ra*rb) AS p, sum((ra-rb)*(ra-rb)) AS sq"""

_PEARSON_SQL = """round(coalesce(CASE WHEN sqrt(greatest((q1 - s1*s1/n)*(q2 - s2*s2/n), 0.0)) <> 0
   THEN (p - s1*s2/n) / sqrt(greatest((q1 - s1*s1/n)*(q2 - s2*s2/n), 0.0)) END, 0.0), 9)"""

_SIM_ALL_SQL = f"""WITH {PREFS_SQL},
mine AS (SELECT item_id, rating AS ra FROM prefs WHERE user_id = {PERSON}),
sums AS (
  SELECT other, {_PAIR_SUMS_SQL}
  FROM (SELECT o.user_id AS other, o.rating AS rb, m.ra
        FROM prefs o JOIN mine m ON o.item_id = m.item_id WHERE o.user_id <> {PERSON}) j
  GROUP BY other)
"""


@register("r1_sim_distance", sql=_SIM_ALL_SQL + "SELECT other, 1.0/(1.0 + round(sq, 9)) AS score FROM sums")
def r1_sim_distance(spark, sf):
    """Distance similarity of PERSON to every user sharing an item."""
    return R.similarity_to_all(Tables(spark, sf).prefs(), PERSON, "distance")


@register("r2_sim_pearson", sql=_SIM_ALL_SQL + f"SELECT other, {_PEARSON_SQL} AS score FROM sums")
def r2_sim_pearson(spark, sf):
    """Pearson similarity of PERSON to every user sharing an item."""
    return R.similarity_to_all(Tables(spark, sf).prefs(), PERSON, "pearson")


@register("r3_top_matches", sql=_SIM_ALL_SQL + f"""
, users AS (SELECT DISTINCT user_id AS other FROM prefs WHERE user_id <> {PERSON})
SELECT u.other, coalesce({_PEARSON_SQL.replace('q1', 's.q1').replace('q2', 's.q2')}, 0.0) AS score
FROM users u LEFT JOIN sums s ON u.other = s.other
ORDER BY score DESC, u.other DESC LIMIT 5""")
def r3_top_matches(spark, sf):
    """The 5 users most similar to PERSON (Pearson), ties by id descending."""
    return R.top_matches(Tables(spark, sf).prefs(), PERSON, 5, "pearson")


@register("r4_user_recommendations", sql=_SIM_ALL_SQL + f"""
, sims AS (SELECT other, {_PEARSON_SQL} AS score FROM sums),
pos AS (SELECT * FROM sims WHERE score > 0)
SELECT p.item_id, sum(p.rating * s.score) / sum(s.score) AS score
FROM prefs p JOIN pos s ON p.user_id = s.other
WHERE p.item_id NOT IN (SELECT item_id FROM prefs WHERE user_id = {PERSON} AND rating <> 0)
GROUP BY p.item_id""")
def r4_user_recommendations(spark, sf):
    """User-based recommendations for PERSON (Pearson weights)."""
    return R.user_recommendations(Tables(spark, sf).prefs(), PERSON, "pearson")


@register("r5_transpose", sql=f"WITH {PREFS_SQL} SELECT item_id AS user_id, user_id AS item_id, rating FROM prefs")
def r5_transpose(spark, sf):
    """Item-centred preferences."""
    return R.transpose(Tables(spark, sf).prefs())


_R6_SQL = f"""{PREFS_SQL},
pairs AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, 1.0/(1.0 + round(sum((a.rating-b.rating)*(a.rating-b.rating)), 9)) AS similarity
  FROM prefs a JOIN prefs b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY 1, 2),
both_ways AS (SELECT item_a, item_b, similarity FROM pairs
              UNION ALL SELECT item_b, item_a, similarity FROM pairs),
ranked AS (SELECT item_a AS item_id, item_b AS other_item, similarity,
                  row_number() OVER (PARTITION BY item_a ORDER BY similarity DESC, item_b DESC) AS rank
           FROM both_ways)"""


@register("r6_similar_items", sql=f"WITH {_R6_SQL} SELECT * FROM ranked WHERE rank <= {N_SIMILAR}")
def r6_similar_items(spark, sf):
    """For every item its 10 nearest items (distance similarity)."""
    prefs = cut_lineage(Tables(spark, sf).prefs())   # read by the key counts and both join sides
    return R.similar_items(prefs, N_SIMILAR)


_R7_SQL = f"""WITH {_R6_SQL},
im AS (SELECT * FROM ranked WHERE rank <= {N_SIMILAR})
SELECT p.user_id, im.other_item AS item_id, sum(im.similarity * p.rating) / sum(im.similarity) AS score
FROM prefs p JOIN im ON p.item_id = im.item_id
WHERE NOT EXISTS (SELECT 1 FROM prefs q WHERE q.user_id = p.user_id AND q.item_id = im.other_item)
GROUP BY 1, 2"""


@register("r7_item_recommendations", sql=_R7_SQL)
def r7_item_recommendations(spark, sf):
    """Item-based recommendations for every customer (flagship)."""
    prefs = cut_lineage(Tables(spark, sf).prefs())   # read four times below
    neighbours = cut_lineage(R.similar_items(prefs, N_SIMILAR))   # a stored table of neighbours serves as well
    return R.item_recommendations(prefs, neighbours)


@register("j4_co_rated", sql=f"""WITH {PREFS_SQL}
SELECT a.item_id, a.rating AS ra, b.rating AS rb
FROM prefs a JOIN prefs b ON a.item_id = b.item_id WHERE a.user_id = {PERSON} AND b.user_id = 42""")
def j4_co_rated(spark, sf):
    """Items rated by both PERSON and customer 42."""
    return R.co_rated(Tables(spark, sf).prefs(), PERSON, 42)


@register("j5_unseen_items", sql=f"""WITH {PREFS_SQL}
SELECT DISTINCT item_id FROM prefs
WHERE item_id NOT IN (SELECT item_id FROM prefs WHERE user_id = {PERSON} AND rating <> 0)""")
def j5_unseen_items(spark, sf):
    """Items PERSON has not rated."""
    return R.unseen_items(Tables(spark, sf).prefs(), PERSON)


@register("r1_sim_pair", sql=f"""WITH {PREFS_SQL},
j AS (SELECT a.rating AS ra, b.rating AS rb FROM prefs a JOIN prefs b ON a.item_id = b.item_id
      WHERE a.user_id = {PERSON} AND b.user_id = 1378)
SELECT CASE WHEN count(*) = 0 THEN 0.0 ELSE 1.0/(1.0 + round(sum((ra-rb)*(ra-rb)), 9)) END AS score FROM j""")
def r1_sim_pair(spark, sf):
    """Distance similarity of one pair of customers."""
    return R.sim_pair(Tables(spark, sf).prefs(), PERSON, 1378, "distance")
