"""Quality classifier: perplexity under an interpolated modified Kneser-Ney
model of trusted text.

The model is one of 4-grams of UTF-16 units per language: four units fill a
64-bit key exactly, so no hash is involved, its context is the key shifted
right by one unit, and its shorter suffix the key without the first unit. The
counts of all trusted documents, bar a held-out tenth, are used. One pass
yields the distinct grams of the corpus with their trusted counts; adjusted
counts, discounts and context sums are aggregates of that table; and the log
probability of every gram that occurs anywhere comes from joins of these
tables, dealt out by (language, gram). A second pass sums the log probabilities
of each document's grams. Documents never are shuffled.

The second pass sends the gram table to the tasks in parts of at most
``broadcast_bytes``, whole languages together where they fit, a larger language
cut by a hash of the gram; sums of the parts are added.

Every trusted document is also scored by a model that leaves out its own tenth
(the held-out tenth by the model itself); these models are further languages of
the same tables. A document is rejected if its perplexity exceeds ``margin``
times the ``quantile`` of these scores of its language.

Repeated words are likely under any model of trusted text, so a second measure
looks at longer grams: the share of a document's ``WINDOW``-grams that are
distinct. A document is rejected if it is below the lower quantile (1 -
``quantile``) of its language's trusted documents, over ``margin``.

A language with fewer than ``min_held`` such documents takes its quantile from
all languages: that of perplexity over the language's median, times its own
median, and that of the share as it is.

Defined cases: null and empty texts have no perplexity and are rejected; a null
language is a language of its own; a language without a trusted document, or
with those of one tenth only, has no perplexity threshold and is judged by the
share alone; texts shorter than a window have no share; without any trusted
document everything with a text is kept; labels without a
document, repeated labels and null ids in labels do nothing; repeated rows are
scored alike. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quarry.llm.common import cut_lineage, fits_broadcast, hashed_key, map_frames

ORDER = 4
UNIT = 16  # bits
PAD = "\n" * (ORDER - 1)  # a text's start is like a line's
CHUNK = 1 << 19  # units looked at together
HELD_OUT = 10  # folds of the trusted documents; the model leaves out the first
WINDOW = 16  # units of the grams whose distinct share is measured


def _chunks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, number of their text), at most about CHUNK at a time."""
    units, owners, held = [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        u = np.frombuffer((PAD + t).encode("utf-16-le"), "<u2").astype(np.uint64)
        for at in range(0, len(u) - ORDER + 1, CHUNK):
            part = u[at:at + CHUNK + ORDER - 1]
            n = len(part) - ORDER + 1
            gram = np.zeros(n, np.uint64)
            for k in range(ORDER):
                gram = (gram << np.uint64(UNIT)) | part[k:k + n]
            units.append(gram)
            owners.append(np.full(n, i))
            held += n
            if held >= CHUNK:
                yield np.concatenate(units), np.concatenate(owners)
                units, owners, held = [], [], 0
    if held:
        yield np.concatenate(units), np.concatenate(owners)


def distinct_shares(texts: list[str]) -> np.ndarray:
    """Share of distinct grams of WINDOW units of each text, repeats looked
    for within CHUNK units; nan if it has none. Grams stand as 64-bit hashes."""
    out = np.full(len(texts), np.nan)
    for i, t in enumerate(texts):
        u = np.frombuffer((t or "").encode("utf-16-le"), "<u2")
        total, distinct = len(u) - WINDOW + 1, 0
        for at in range(0, total, CHUNK):
            part = u[at:at + CHUNK + WINDOW - 1].astype(np.uint64)
            gram = np.zeros(len(part) - WINDOW + 1, np.uint64)
            for k in range(WINDOW):
                gram = gram * np.uint64(0x9E3779B97F4A7C15) + part[k:k + len(gram)] + np.uint64(1)
            distinct += len(pd.unique(gram))
        if total > 0:
            out[i] = distinct / total
    return out


@F.pandas_udf(DoubleType())
def _share(text: pd.Series) -> pd.Series:
    out = pd.Series(distinct_shares(text.tolist()), dtype=object)
    return out.where(out.notna(), None)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n0, n1, ...) of documents (lang, text, fold): every distinct
    gram of the corpus and how often the trusted text of each fold has it.
    Documents of fold -1 are not trusted."""
    flush = 1 << 21

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], pd.Series] = {}
        for frame in frames:
            for key, part in frame.groupby(["lang", "fold"], sort=True):
                for gram, _ in _chunks(part["text"].tolist()):
                    codes, keys = pd.factorize(gram)
                    n = np.bincount(codes, minlength=len(keys)) if key[1] >= 0 else np.zeros(len(keys), np.int64)
                    new = pd.Series(n, index=keys)
                    old = held.get(key)
                    held[key] = new if old is None else old.add(new, fill_value=0).astype(np.int64)
            if sum(map(len, held.values())) > flush:
                yield from out(held)
                held = {}
        yield from out(held)

    def out(held):
        for (lang, fold), s in held.items():
            yield pd.DataFrame({"lang": lang, "fold": fold, "gram": s.index.to_numpy(np.uint64).view(np.int64), "n": s.to_numpy(np.int64)})

    n = [F.sum(F.when(F.col("fold") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(HELD_OUT)]
    return docs.mapInPandas(run, "lang string, fold int, gram long, n long").groupBy("lang", "gram").agg(*n)


def _model(fold: Column, lang: Column) -> Column:
    """Name of the model of a language that leaves out a fold. Fold 0's is the
    one that scores the corpus."""
    return F.concat(fold.cast("string"), lang)


def model_counts(counts: DataFrame) -> DataFrame:
    """(lang, gram, n, wanted) of each model, from ``gram_counts``: its training
    counts, and whether it is to score the gram. Fold 0's model scores all."""
    total = sum((F.col(f"n{i}") for i in range(1, HELD_OUT)), F.col("n0"))
    models = [F.struct(_model(F.lit(i), F.col("lang")).alias("lang"), "gram", (total - F.col(f"n{i}")).alias("n"),
                       (F.lit(True) if i == 0 else F.col(f"n{i}") > 0).alias("wanted")) for i in range(HELD_OUT)]
    return counts.select(F.explode(F.array(*models)).alias("m")).select("m.*").where("wanted OR n > 0")


def _suffix(gram: Column, order: int) -> Column:
    """The last ``order`` units."""
    return gram.bitwiseAND(F.lit((1 << UNIT * order) - 1))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, UNIT)


def _discounts(adjusted: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Modified Kneser-Ney discounts by language from the counts of counts."""
    found = adjusted.groupBy("lang").agg(*[F.sum((F.col("a") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()
    out = {}
    for r in found:
        n1, n2, n3, n4 = (r[f"n{i}"] for i in (1, 2, 3, 4))
        if min(n1, n2, n3) > 0:
            y = n1 / (n1 + 2 * n2)
            raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        else:
            raw = (0.5, 1.0, 1.5)
        out[r["lang"]] = tuple(min(max(d, 0.1), i) for i, d in enumerate(raw, 1))
    return out


def _by_lang(lang: Column, values: dict[str, float]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv]) if values else None
    return F.lit(0.0) if table is None else F.coalesce(F.try_element_at(table, lang), F.lit(0.0))


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(lang, gram, log_p) for every wanted gram of ``counts`` (lang, gram, n,
    wanted) whose language has training text."""
    adjusted = {ORDER: counts.where("n > 0").select("lang", "gram", F.col("n").alias("a"))}
    wanted = {ORDER: counts.where("wanted").select("lang", "gram")}
    for k in range(ORDER - 1, 0, -1):
        adjusted[k] = cut_lineage(adjusted[k + 1].groupBy("lang", _suffix(F.col("gram"), k).alias("gram"))
                                  .agg(F.count(F.lit(1)).alias("a")))
        wanted[k] = cut_lineage(wanted[k + 1].select("lang", _suffix(F.col("gram"), k).alias("gram")).distinct())
    lower = None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = ({}, {}, {})
        for lang, d in _discounts(adjusted[k]).items():
            d1[lang], d2[lang], d3[lang] = d
        lang, a = F.col("lang"), F.col("a")
        off = F.when(a == 1, _by_lang(lang, d1)).when(a == 2, _by_lang(lang, d2)).otherwise(_by_lang(lang, d3))
        seen = adjusted[k].select("lang", "gram", "a", off.alias("off"))
        context = (seen.groupBy("lang", _context(F.col("gram")).alias("context"))
                   .agg(F.sum("a").alias("total"), F.sum("off").alias("saved")))
        rows = wanted[k].join(seen, ["lang", "gram"], "left").withColumns(
            {"context": _context(F.col("gram")), "suffix": _suffix(F.col("gram"), k - 1) if k > 1 else F.lit(0).cast("long")})
        rows = rows.join(context, ["lang", "context"], "left")
        if lower is None:
            rows = rows.where("total IS NOT NULL").withColumn("p_low", F.lit(1.0 / (1 << UNIT)))
        else:
            rows = rows.join(lower, ["lang", "suffix"])
        own = F.coalesce((a - F.col("off")) / F.col("total"), F.lit(0.0))
        share = F.coalesce(F.col("saved") / F.col("total"), F.lit(1.0))
        lower = cut_lineage(rows.select("lang", F.col("gram").alias("suffix"), (own + share * F.col("p_low")).alias("p_low")))
    return lower.select("lang", F.col("suffix").alias("gram"), F.log("p_low").alias("log_p"))


def _parts(sizes: dict[str, int], most: int) -> list[tuple[list[str], int, int]]:
    """(languages, shard, shards) so that no part has many more than most rows."""
    parts, held, n = [], [], 0
    for lang, size in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        if size > most:
            k = math.ceil(size / most)
            parts += [([lang], i, k) for i in range(k)]
        elif n + size > most:
            parts.append((held, 0, 1))
            held, n = [lang], size
        else:
            held, n = [*held, lang], n + size
    return parts + ([(held, 0, 1)] if held else [])


def score(docs: DataFrame, log_p: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(doc_id, k1, k2, lang, n_units, sum_log_p) of documents (doc_id, k1, k2,
    lang, text); a row for each row, and for each part of its language."""
    spark = docs.sparkSession
    sizes = {r["lang"]: r["n"] for r in log_p.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "doc_id long, k1 long, k2 long, lang string, n_units long, sum_log_p double"
    out = None
    for langs, shard, shards in _parts(sizes, broadcast_bytes // 16):
        by_lang = {}
        for lang in langs:  # one at a time: keys and values alone come to the driver, broadcast_bytes at most
            mine = log_p.where((F.col("lang") == lang) & (F.pmod(F.xxhash64("gram"), F.lit(shards)) == shard))
            part = mine.select("gram", F.col("log_p").cast("float").alias("log_p")).toArrow()
            keys = part["gram"].to_numpy().view(np.uint64)
            order = np.argsort(keys)
            by_lang[lang] = keys[order], part["log_p"].to_numpy()[order]
        sent = spark.sparkContext.broadcast(by_lang)

        def run(pdf: pd.DataFrame, sent=sent) -> pd.DataFrame:
            sums, units = np.zeros(len(pdf)), np.zeros(len(pdf), np.int64)
            pdf = pdf.reset_index(drop=True)
            for lang, part in pdf.groupby("lang"):
                keys, values = sent.value[lang]
                rows = part.index.to_numpy()
                for gram, owner in _chunks(part["text"].tolist()):
                    codes, distinct = pd.factorize(gram)
                    at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
                    found = np.where(keys[at] == distinct, values[at], np.float32(0))
                    sums[rows] += np.bincount(owner, found[codes], len(rows))
                    units[rows] += np.bincount(owner, minlength=len(rows))
            return pdf[["doc_id", "k1", "k2", "lang"]].astype({"doc_id": "Int64"}).assign(n_units=units, sum_log_p=sums)

        part = map_frames(docs.where(F.col("lang").isin(langs)), run, schema)
        part = part.withColumn("shards", F.lit(shards))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema + ", shards int")
    return out


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, margin: float = 1.15, min_held: int = 10,
             broadcast_bytes: int = 64 << 20, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, k1, k2 (row key), lang, n_units,
    perplexity, threshold (of its language; null without one), distinct_share,
    least_share (its threshold) and kept.
    Trusted are the documents that ``labels`` (doc_id, quality, toxic) gives
    quality 1 and not toxic."""
    trusted = (labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
               .select(F.col("doc_id").cast("long").alias("__id")).distinct())
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"),
                       F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(lang).isNull().alias("no_lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    fold = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HELD_OUT)).cast("int")
    marked = (rows.join(fits_broadcast(trusted, 16, broadcast_bytes), F.col("doc_id") == F.col("__id"), "left")
              .withColumn("fold", F.when(F.col("__id").isNotNull(), fold).otherwise(-1)))
    counts = model_counts(cut_lineage(gram_counts(marked.select("lang", "text", "fold"))))
    folds = F.when(F.col("fold") > 0, F.array(F.lit(0), "fold")).otherwise(F.array(F.lit(0)))
    asked = (marked.select("doc_id", "k1", "k2", "lang", "text", F.explode(folds).alias("model"))
             .withColumn("lang", _model(F.col("model"), F.col("lang"))).drop("model"))
    parts = score(asked, log_probabilities(counts), broadcast_bytes)
    # copies of a row give the same sums, so their mean, times the parts, stands for each
    scored = (parts.groupBy("k1", "k2", "lang").agg((F.avg("sum_log_p") * F.max("shards")).alias("sum_log_p"),
                                                    F.max("n_units").alias("n_units")))
    ppl = F.when(F.col("n_units") > 0, F.exp(-F.col("sum_log_p") / F.col("n_units")))
    whole = F.col("lang").startswith("0")
    scored = (scored.groupBy("k1", "k2", F.expr("substring(lang, 2)").alias("lang"))
              .agg(F.max(F.when(whole, F.col("n_units"))).alias("n_units"), F.max(F.when(whole, ppl)).alias("perplexity"),
                   F.max(F.when(~whole, ppl)).alias("unseen")))
    named = marked.select("doc_id", "k1", "k2", "lang", "no_lang", "fold", (F.length("text") > 0).alias("has_text"),
                          _share("text").alias("distinct_share")).join(scored, ["k1", "k2", "lang"], "left")
    named = cut_lineage(named.withColumn("unseen", F.when(F.col("fold") == 0, F.col("perplexity")).otherwise(F.col("unseen"))))

    def at(value: str | Column, q: float) -> Column:
        return F.percentile_approx(value, F.lit(q), F.lit(10000))

    held = named.where("fold >= 0")
    limits = cut_lineage(held.groupBy("lang").agg(
        at("unseen", quantile).alias("q"), at("unseen", 0.5).alias("mid"), F.count("unseen").alias("n_held"),
        at("distinct_share", 1 - quantile).alias("low"), F.count("distinct_share").alias("n_share")))
    limits = fits_broadcast(limits, 64, 1 << 20)  # a row for each language
    pooled = held.join(limits, "lang").agg(at(F.col("unseen") / F.col("mid"), quantile).alias("q"),
                                           at("distinct_share", 1 - quantile).alias("low")).first()
    every = F.lit(pooled["low"]).cast("double")
    high = F.when(F.col("n_held") >= min_held, F.col("q")).otherwise(F.col("mid") * F.lit(pooled["q"]).cast("double"))
    low = F.when(F.col("n_share") >= min_held, F.col("low")).otherwise(every)
    out = named.join(limits, "lang", "left").withColumns({"threshold": high * margin, "least_share": low / margin})
    kept = (F.col("has_text") & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
            & F.coalesce(F.col("distinct_share") >= F.col("least_share"), F.lit(True)))
    return out.select("doc_id", "k1", "k2", F.when(~F.col("no_lang"), F.col("lang")).alias("lang"),
                      F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"), "perplexity", "threshold",
                      "distinct_share", "least_share", kept.alias("kept"))
