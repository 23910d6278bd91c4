"""Short-message entities and reports (inventory F18-F20, H1-H3).

Entities are found inside the row and exploded once; reports are aggregates
over (message, kind, value) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T

# What counts as an entity, without groups, so that split and
# extract see the same matches.
ENTITY_PATTERNS = {"mention": r"@[A-Za-z0-9_]+", "url": r"https?://[^\s]+", "hashtag": r"#[A-Za-z0-9_]+"}
SOURCE = r"(?i)(RT|via)((?:\b\W*@\w+)+)"


def retweet_sources(text: Column, author: Column | None = None) -> Column:
    """the accounts a message is taken from: the structured author, if
    any, and the accounts named behind the first RT or via; lower case,
    without @, distinct."""
    named = F.transform(F.regexp_extract_all(F.regexp_extract(text, SOURCE, 2), F.lit(r"@(\w+)"), 1), lambda x: F.lower(x))
    if author is None:
        return F.array_distinct(named)
    given = F.when(author.isNotNull(), F.array(F.lower(author))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(given, named))


def matches_with_index(text: Column, pattern: str) -> Column:
    """Array of (value, start): the matches of a pattern without groups, and
    where they begin (from 0).  The text between matches gives the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern)

    def total(parts: Column, n: Column) -> Column:
        return F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda a, x: a + F.length(x))

    return F.transform(found, lambda m, i: F.struct(m.alias("value"), (total(gaps, i + 1) + total(found, i)).alias("start")))


def entities(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, value, start) of every mention, URL and hashtag."""
    def of_kind(kind: str) -> Column:
        return F.transform(matches_with_index(F.col(text), ENTITY_PATTERNS[kind]),
                           lambda x: F.struct(F.lit(kind).alias("kind"), x["value"].alias("value"), x["start"].alias("start")))

    parts = [of_kind(k) for k in ENTITY_PATTERNS]
    return df.select(key, F.explode(F.concat(*parts)).alias("e")).select(key, "e.kind", "e.value", "e.start")


ENTITY_SCHEMA = ("user_mentions array<struct<screen_name:string>>, hashtags array<struct<text:string>>, "
                 "urls array<struct<url:string>>, media array<struct<url:string>>, symbols array<struct<text:string>>")


def flatten_entities(df: DataFrame, key: str, json: str) -> DataFrame:
    """(key, kind, value) of the nested entity lists of a JSON column;
    a missing list has no rows (Q15)."""
    e = F.from_json(F.col(json), ENTITY_SCHEMA)
    lists = {"screen_name": ("user_mentions", "screen_name"), "hashtag": ("hashtags", "text"), "url": ("urls", "url"),
             "media": ("media", "url"), "symbol": ("symbols", "text")}
    none = F.array().cast("array<struct<kind:string,value:string>>")

    def of_kind(kind: str) -> Column:
        field, name = lists[kind]
        return F.coalesce(F.transform(F.col("e")[field][name], lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("value"))), none)

    parts = [of_kind(k) for k in lists]
    return (df.select(key, e.alias("e")).select(key, F.explode(F.concat(*parts)).alias("x"))
            .select(key, "x.kind", "x.value"))


def common_entities(flat: DataFrame, threshold: int = 3) -> DataFrame:
    """H1: (kind, value, n) of entities with ``threshold`` uses or more."""
    return flat.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= threshold)


def content_report(df: DataFrame, flat: DataFrame, text: str) -> DataFrame:
    """H2: one row: lexical diversity of words, of screen names and of
    hashtags, and mean words per message."""
    words = df.select(T.ws_tokens(text).alias("w"))
    w = words.select(F.explode("w").alias("w"))

    def diversity(kind: str) -> Column:
        v = F.when(F.col("kind") == kind, F.col("value"))
        return F.countDistinct(v) / F.count(v)

    # aggregates of one row each, put side by side
    parts = {"word_diversity": w.agg((F.countDistinct("w") / F.count("w")).alias("x")), "avg_words": words.agg(F.avg(F.size("w")).alias("x")),
             "screen_name_diversity": flat.agg(diversity("screen_name").alias("x")), "hashtag_diversity": flat.agg(diversity("hashtag").alias("x"))}
    rows = reduce(lambda a, b: a.union(b), [df_.select(F.lit(name).alias("name"), "x") for name, df_ in parts.items()])
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("x"))).alias(name) for name in parts])


def favourites_report(df: DataFrame, flat: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """H3: common entities with two uses or more, and the content report."""
    return common_entities(flat, 2), content_report(df, flat, text)
