"""URL filter: host and path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The list is a DataFrame of any size. Its Bloom filter has a fixed greatest
size and is broadcast; only URLs that pass it are joined with the list itself,
by equality of the canonical URL, which removes false positives.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is never listed: it is allowed. Repeated rows get the same
verdict. Null URLs in the list are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import bloom
from quarry.llm.common import lower_ascii

TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|ref)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) of the URLs whose host is ``host`` or below
    it and whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, prefix: str) -> Rule:
        host, slash, rest = prefix.partition("/")
        return cls(verdict, host, slash + rest)

    @property
    def prefix(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes,
    query without tracking parameters; scheme and fragment go. Null without
    ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|(?<=&)){TRACKING}=[^&]*(?:&|$)", "")
    query = F.regexp_replace(query, r"&+$", "")
    tail = F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def match_rules(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Prefix and verdict of the longest rule that fits; null if none does. Of
    rules of one length that with the longer host wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.prefix), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url", listed_url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, listed (boolean) and verdict.

    A rule's verdict stands; other URLs are blocked if their canonical form is
    the canonical form of a URL in ``listed``. Columns of those names in the
    input are replaced."""
    keys = listed.select(canonical(F.col(listed_url)).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    n_keys = keys.agg(F.approx_count_distinct("__key", 0.02).alias("n")).first()["n"]
    u = F.col(url)
    rows = pages.withColumn("__canon", canonical(u))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    rows = (rows.withColumns({"host": host_of(u), "path": path_of(u)})
            .withColumn("rule", rule).withColumn("__by_rule", verdict))
    rows = bloom.flagged(rows, "__canon", keys, "__key", n_keys, "__maybe")
    # only possible hits meet the list; all others skip the join with a null key,
    # dealt out by themselves so that they do not gather in one task
    may = rows.where("__maybe")
    hits = may.join(keys, F.col("__canon") == F.col("__key"), "left").withColumn("listed", F.col("__key").isNotNull())
    out = hits.drop("__key").unionByName(rows.where("NOT __maybe").withColumn("listed", F.lit(False)))
    return (out.withColumn("verdict", F.coalesce("__by_rule", F.when(F.col("listed"), "block").otherwise("allow")))
            .drop("__canon", "__by_rule", "__maybe"))
