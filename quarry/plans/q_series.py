"""Registered queries: daily series aligned by date (price-history matrix)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.registry import register
from quarry.sources.tables import Tables

# The event types of the given tables, for the oracle alone.
TYPES = ["click", "error", "purchase", "signup", "view"]


@register("io23_series_matrix", sql="SELECT d, " + ", ".join(
    f"round(sum(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in TYPES) + """
FROM (SELECT ts::DATE AS d, event_type, value FROM events) GROUP BY d
HAVING """ + " AND ".join(f"count(*) FILTER (WHERE event_type = '{t}') > 0" for t in TYPES))
def io23(spark, sf):
    """Daily value per event type, one column per type, dates present for
    every type only (series aligned by date, Q4 default)."""
    e = Tables(spark, sf).events.select(F.to_date("ts").alias("d"), "event_type", "value")
    wide = e.groupBy("d").pivot("event_type").agg(F.sum("value"))   # every type that the table has
    types = [c for c in wide.columns if c != "d"]
    return wide.select("d", *[F.round(F.col(f"`{t}`"), 6).alias(t) for t in types]).dropna()
