"""Typed rows out of XML columns (inventory IO14-IO17, IO25), by ``from_xml``
with explicit schemas; nothing is inferred and nothing leaves the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEED = "channel struct<item: array<struct<title: string, summary: string, description: string>>>"


def feed_entries(df: DataFrame, key: str, xml: str) -> DataFrame:
    """IO14: (key, pos, title, text) of every entry of a stored feed; the text
    is the summary, or the description where there is none."""
    e = df.select(key, F.posexplode(F.from_xml(F.col(xml), FEED)["channel"]["item"]).alias("pos", "e"))
    return e.select(key, "pos", F.col("e.title").alias("title"), F.coalesce("e.summary", "e.description").alias("text"))


def property_rows(df: DataFrame, key: str, xml: str) -> DataFrame:
    """IO15: (key, zip, use, year, bath, bed, price) of a property record;
    records without a complete address part are dropped, an empty price is 0."""
    schema = "zipcode string, useCode string, yearBuilt int, bathrooms double, bedrooms int, amount double"
    r = df.select(key, F.from_xml(F.col(xml), schema).alias("r")).select(key, "r.*")
    return (r.dropna(subset=["zipcode", "useCode", "yearBuilt", "bathrooms", "bedrooms"])
            .select(key, "zipcode", "useCode", "yearBuilt", "bathrooms", "bedrooms", F.coalesce("amount", F.lit(0.0)).alias("price")))


def item_rows(df: DataFrame, key: str, xml: str) -> DataFrame:
    """IO16: (key, item_id, title, price, ends), one row per item of a result
    list, ``-1`` for a missing tag."""
    schema = "Item array<struct<ItemId: string, Title: string, CurrentPrice: string, EndTime: string>>"
    i = df.select(key, F.explode(F.from_xml(F.col(xml), schema)["Item"]).alias("i"))
    names = {"ItemId": "item_id", "Title": "title", "CurrentPrice": "price", "EndTime": "ends"}
    return i.select(key, *[F.coalesce(F.col(f"i.{a}"), F.lit("-1")).alias(b) for a, b in names.items()])


def attribute_vectors(df: DataFrame, key: str, xml: str, required: list[str]) -> DataFrame:
    """IO17: (key, vec) of the required attributes' numbers in the order given;
    items that lack one are dropped.  The list is looked up inside the row; of
    an attribute that is given twice the first counts."""
    attrs = F.from_xml(F.col(xml), "Attribute array<struct<id: string, value: string>>")["Attribute"]
    got = df.select(key, attrs.alias("m"))
    first = lambda a: F.get(F.filter("m", lambda x: x["id"] == a), F.lit(0))["value"]
    vec = F.array(*[first(a).try_cast("double") for a in required])
    return got.select(key, vec.alias("vec")).where(~F.exists("vec", lambda x: x.isNull()))


PROFILE = ("name string, sex string, status string, hometown struct<city: string, state: string>, "
           "affiliations array<struct<type: string, name: string, year: string>>")


def user_profiles(df: DataFrame, key: str, xml: str) -> DataFrame:
    """IO25: (key, name, sex, status, location, college, year) of a profile; the
    college is the last affiliation of type 1, its year '0' if not given."""
    p = df.select(key, F.from_xml(F.col(xml), PROFILE).alias("p"))
    college = F.try_element_at(F.filter("p.affiliations", lambda a: a["type"] == "1"), F.lit(-1))
    none = F.lit("")
    return p.select(key, "p.name", "p.sex", "p.status", F.concat_ws(", ", "p.hometown.city", "p.hometown.state").alias("location"),
                    F.coalesce(college["name"], none).alias("college"), F.coalesce(college["year"], F.lit("0")).alias("year"))


def tag(name: str, value: Column, attrs: str = "") -> Column:
    """An element around a value; null without one."""
    return F.concat(F.lit(f"<{name}{attrs}>"), value.cast("string"), F.lit(f"</{name}>"))
