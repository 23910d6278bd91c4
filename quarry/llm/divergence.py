"""How far apart the sources of a language are, term by term.

Texts are cut into terms in Arrow columns and dealt, row by row, into shards
of a language's vocabulary: a term's hash names its shard, and the number
of shards follows an estimate of the language's distinct terms, so that a
vocabulary of any size is made of parts of bounded size. A ``CountVectorizer``
with ``minDF`` and the largest vocabulary size is fitted per language and
shard. The documents' sparse count vectors over it are made in Arrow columns
(the model's own function takes over 2 us a term, ten times as long) and summed
by source in the task that makes them, the tasks' sums by a shuffle.

A share p of a term depends on its count and on the group's totals alone, and
a term that a source lacks has the source's base share p0. So the divergence
f(p, q) of a pair, summed over the whole vocabulary, is
``sum f(p, q0)`` over the first source's counts, zeros included,
plus ``sum f(p0, q) - f(p0, q0)`` over the second's, both from histograms of
counts, plus ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)`` for the terms that
both hold. Only the last sum meets terms: blocks of indices, with the sources
of a language in a grid of cells of ``CELL`` sources, so that a task holds at
most a block of two cells. All arithmetic is on integers.

Defined cases: null text, language and source count as ''. A language without
a kept term has V = 0, pairs of value 0 and no terms. Groups without terms
take part with counts of 0. Repeated rows and ids are documents of their own.
Ties go by item. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, fits_broadcast, scratch_path

MIN_DOCS = 3
TOP_TERMS = 200
#: Distinct terms of a shard, about; its vocabulary passes through one task and the driver.
SHARD_TERMS = 1 << 19
#: Indices of a block and sources of a cell of the pair evaluation.
BLOCK, CELL = 4096, 256
#: Rows and bytes of text that are cut into terms together.
ROWS, TEXT_BYTES = 2048, 4 << 20
#: Fits that run side by side.
THREADS = 2
#: A term no text can hold; it keeps a vocabulary from being empty.
NO_TERM = " "

_CUT = np.full(256, 0x20, np.uint8)
for _b in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _CUT[_b] = _b + 0x20 if 0x41 <= _b <= 0x5A else _b


def _terms(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row number of each term, and the terms of all rows in order. Bytes
    other than letters and those beyond ASCII become blanks, A-Z become a-z."""
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    flat = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(_CUT[data]))
    lists = pc.ascii_split_whitespace(flat)
    rows, terms = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
    keep = pc.greater(pc.binary_length(terms), 0)
    return rows[keep.to_numpy(zero_copy_only=False)], terms.filter(keep)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``ROWS`` rows and ``TEXT_BYTES`` of
    text (the last column), or of a single longer text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            n = max(1, min(ROWS, int(np.searchsorted(ends, done + TEXT_BYTES, "right")) - at))
            yield batch.slice(at, n)
            at += n


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of an ordered array begin."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)


def _hashes(terms: pa.LargeStringArray) -> np.ndarray:
    """A number of 63 bits for each of these terms, none of them empty."""
    if not len(terms):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset:terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    powers = np.cumprod(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(starts, sizes)], starts)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((h ^ (h >> np.uint64(33))) >> np.uint64(1)).astype(np.int64)


def _first(rows: np.ndarray, lang: np.ndarray, codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the terms without a document's repeats and without those
    that ``most`` documents of the language before hold too."""
    width, langs = int(rows[-1]) + 1, int(lang.max()) + 1
    key = np.sort((codes * langs + lang[rows]) * width + rows)
    key = key[_starts(key)]
    start = _starts(key // width)
    key = key[np.arange(len(key)) - np.repeat(start, np.diff(start, append=len(key))) < most]
    return key % width, key // width // langs


def terms_of(docs: DataFrame, shards: dict[str, int] | None = None, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, shard, terms, some) per document and shard with a term,
    of rows (lang, source, text) without a null language or source; terms are
    strings joined by blanks.

    ``some`` holds the document's terms once, less those that ``min_docs``
    documents of its language before it in the same slice hold: enough to tell
    which terms ``min_docs`` documents hold, and fewer.
    ``shards``: shards of each language, one where not named."""
    many = {k: v for k, v in (shards or {}).items() if v > 1}

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, terms = _terms(batch.column(2))
            if not len(rows):
                continue
            coded = terms.dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64)
            n = np.array([many.get(x, 1) for x in batch.column(0).to_pylist()], np.int64)
            sums = _hashes(coded.dictionary) if many else None
            shard_of = lambda r, c: sums[c] % n[r] if many else np.zeros(len(r), np.int64)
            shard, most = shard_of(rows, codes), int(n.max())
            if many:
                order = np.argsort(rows * most + shard, kind="stable")
                rows, shard, codes, terms = rows[order], shard[order], codes[order], terms.take(pa.array(order))
            lists_at = rows * most + shard
            starts = _starts(lists_at)
            r, c = _first(rows, batch.column(0).dictionary_encode().indices.to_numpy().astype(np.int64), codes, min_docs)
            some = np.sort((r * most + shard_of(r, c)) * len(coded.dictionary) + c)
            some_ends = np.r_[np.searchsorted(some, lists_at[starts] * len(coded.dictionary)), len(some)]
            lists = [pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), xs.cast(pa.string())), " ") for ends, xs in (
                (np.r_[starts, len(rows)], terms), (some_ends, coded.dictionary.take(pa.array(some % len(coded.dictionary)))))]
            own = pa.array(rows[starts])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(shard[starts].astype(np.int32)), *lists],
                                             ["lang", "source", "shard", "terms", "some"])

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(
        cut, "lang string, source string, shard int, terms string, some string")


def distinct_terms(docs: DataFrame) -> DataFrame:
    """(lang, n): about how many distinct terms each language has."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            named = batch.column(0).dictionary_encode()
            for i, lang in enumerate(named.dictionary.to_pylist()):
                _, terms = _terms(batch.column(1).filter(pc.equal(named.indices, i)))
                terms = terms.unique().cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(terms)), terms], ["lang", "term"])

    return docs.select("lang", F.col("text").cast("binary")).mapInArrow(cut, "lang string, term string").groupBy("lang").agg(F.approx_count_distinct("term").alias("n"))


def group_sums(rows: DataFrame, vocabulary: Broadcast[list[str]]) -> DataFrame:
    """(source, ix, n): sums by source of the sparse count vectors of rows
    (source, terms, joined by blanks) over the vocabulary of a fitted ``CountVectorizer``.

    A vector holds its document's counts of the terms that have an index; the
    vectors of a batch are summed as they are made."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pa.array(vocabulary.value, pa.string())
        for batch in _slices(batches):
            terms = pc.ascii_split_whitespace(batch.column(1))
            source, coded = batch.column(0).dictionary_encode(), terms.flatten().dictionary_encode()
            found = pc.fill_null(pc.index_in(coded.dictionary, value_set=index), -1).to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(terms).to_numpy())
            ix = found[coded.indices.to_numpy()] if len(found) else found
            held = ix >= 0
            every = np.sort(doc[held] * len(index) + ix[held])
            starts = _starts(every)
            vector, count = every[starts], np.diff(starts, append=len(every))  # (document, index): count
            own = source.indices.to_numpy().astype(np.int64)[vector // len(index)] * len(index) + vector % len(index)
            order = np.argsort(own)
            own = own[order]
            starts = _starts(own)
            key = own[starts]
            n = np.add.reduceat(count[order], starts) if len(key) else key
            yield pa.RecordBatch.from_arrays([source.dictionary.take(pa.array(key // len(index))), pa.array((key % len(index)).astype(np.int32)), pa.array(n)],
                                             ["source", "ix", "n"])

    return rows.mapInArrow(add, "source string, ix int, n long").groupBy("source", "ix").agg(F.sum("n").alias("n"))


def _part(lang: Column, shard: Column) -> Column:
    """The folder of a language's shard, whatever the language's name holds."""
    return F.concat_ws("-", F.md5(lang), shard.cast("string"))


def _fit(terms: DataFrame, folder: str, name: str, min_docs: int) -> None:
    """Fit one part's vocabulary; write it, and the sums of the part's vectors."""
    spark = terms.sparkSession
    own = terms.where(F.col("part") == name)
    more = spark.range(min_docs).select(F.array(F.lit(NO_TERM)).alias("some"))
    counter = CountVectorizer(inputCol="some", outputCol="vector", minDF=float(min_docs), vocabSize=2**31 - 1)
    model = counter.fit(own.where("some <> ''").select(F.split("some", " ").alias("some")).unionByName(more))
    model.write().save(os.path.join(folder, "models", name))
    vocabulary = spark.sparkContext.broadcast(model.vocabulary)  # a part's: about ``shard_terms`` terms at most
    group_sums(own.select("source", "terms"), vocabulary).write.parquet(os.path.join(folder, "sums", name))
    vocabulary.destroy()


def group_counts(docs: DataFrame, min_docs: int = MIN_DOCS, shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, DataFrame]:
    """(lang, source, shard, ix, n): occurrences of each kept term in each
    group, and (lang, shard, ix, term): the kept terms. Both are written."""
    spark = docs.sparkSession
    shards = {r["lang"]: max(1, -(-r["n"] // shard_terms)) for r in distinct_terms(docs).collect()}
    folder = scratch_path(spark, f"divergence-{uuid.uuid4().hex}")
    path = os.path.join(folder, "terms")
    terms_of(docs, shards, min_docs).withColumn("part", _part(F.col("lang"), F.col("shard"))).write.partitionBy("part").parquet(path)
    terms = spark.read.schema("lang string, source string, shard int, terms string, some string, part string").parquet(path)
    parts = [(r["lang"], r["shard"], r["part"]) for r in terms.select("lang", "shard", "part").distinct().collect()]
    if not parts:
        return (spark.createDataFrame([], "lang string, source string, shard int, ix int, n long"),
                spark.createDataFrame([], "lang string, shard int, ix int, term string"))
    with ThreadPoolExecutor(THREADS) as pool:
        for done in [pool.submit(_fit, terms, folder, name, min_docs) for *_, name in parts]:
            done.result()

    def read(lang: str, shard: int, schema: str, *at: str) -> DataFrame:
        return spark.read.schema(schema).parquet(os.path.join(folder, *at)).withColumns({"lang": F.lit(lang), "shard": F.lit(shard)})

    counts = [read(lang, shard, "source string, ix int, n long", "sums", name) for lang, shard, name in parts]
    words = [read(lang, shard, "vocabulary array<string>", "models", name, "data")
             .select("lang", "shard", F.posexplode("vocabulary").alias("ix", "term")) for lang, shard, name in parts]
    return functools.reduce(DataFrame.unionByName, counts), functools.reduce(DataFrame.unionByName, words).where(F.col("term") != NO_TERM)


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + size)), exact."""
    top = F.lit(1_000_000_000).cast("decimal(38,0)") * (n + 1)
    return F.when(total + size > 0, 1 + F.call_function("div", top, (total + size).cast("decimal(38,0)")))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _np_gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms that both sources of a pair hold, for one block of
    indices and one cell of the grid."""
    own, ix, p, p0 = (rows[c].to_numpy() for c in ("own", "ix", "p", "p0"))
    left, right = (rows["cell"] == rows["ca"]).to_numpy(), (rows["cell"] == rows["cb"]).to_numpy()
    ix = ix - ix.min(initial=0)
    others, column = np.unique(own[right], return_inverse=True)
    held = np.full((ix.max(initial=0) + 1, len(others)), -1, np.int64)
    held[ix[right], column] = p[right]
    base = np.zeros(len(others), np.int64)
    base[column] = p0[right]
    out = []
    for source in np.unique(own[left]):
        mine = np.flatnonzero(left & (own == source))
        sub = held[ix[mine]]
        r, c = np.nonzero(sub >= 0)
        a, q, a0, q0 = p[mine][r], sub[r, c], p0[mine[0]], base[c]
        z = np.zeros(len(others), np.int64)
        np.add.at(z, c, _np_gap(a, q) - _np_gap(a, q0) - _np_gap(a0, q) + _np_gap(a0, q0))
        hit = np.unique(c)
        out.append(np.stack([np.full(len(hit), source), others[hit], z[hit]]))
    return pd.DataFrame(np.concatenate(out, axis=1).T if out else np.zeros((0, 3), np.int64), columns=["own", "other", "v"])


def _pairs(groups: DataFrame, shares: DataFrame, cell: int) -> DataFrame:
    """(lang, source, item, value) for all pairs of sources of a language."""
    side = groups.select("lang", F.col("own").alias("other"), F.col("p0").alias("q0"))
    side = fits_broadcast(side, 100, 16 << 20)
    hist = cut_lineage(shares.groupBy("lang", "own", "p", "p0").agg(F.count(F.lit(1)).alias("terms")))
    held = hist.groupBy("own").agg(F.sum("terms").alias("held"))
    lacked = (groups.join(held, "own", "left")
              .select("lang", "own", F.col("p0").alias("p"), "p0", (F.col("size") - F.coalesce("held", F.lit(0))).alias("terms")))
    p, p0, q0, n = F.col("p"), F.col("p0"), F.col("q0"), F.col("terms")
    differ = F.col("own") != F.col("other")
    zero = F.lit(0).cast("long")
    # the second source's base against the first's counts, absent terms included
    one = hist.unionByName(lacked).join(side, "lang").where(differ).select("own", "other", F.coalesce(n * gap(p, q0), zero).alias("v"))
    # the second source's counts against the first's base
    two = (hist.join(side, "lang").where(differ)
           .select(F.col("other").alias("own"), F.col("own").alias("other"), (n * (gap(q0, p) - gap(q0, p0))).alias("v")))
    cells = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("cells"))
    at = lambda a, b: F.struct(F.col(a).alias("ca"), F.col(b).alias("cb"))
    dealt = (shares.join(fits_broadcast(cells, 100, 16 << 20), "lang")
             .withColumn("cell", F.pmod(F.xxhash64("own"), F.col("cells")).cast("int"))
             .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
             .withColumn("at", F.explode(F.array_distinct(F.array(at("cell", "met"), at("met", "cell")))))
             .select("lang", "own", "shard", "ix", "p", "p0", "cell", "at.ca", "at.cb", F.expr(f"ix div {BLOCK}").alias("block")))
    three = dealt.groupBy("lang", "shard", "block", "ca", "cb").applyInPandas(_shared, "own long, other long, v long").where(differ)
    names = fits_broadcast(groups.select("lang", "own", "source"), 200, 16 << 20)
    items = fits_broadcast(groups.select(F.col("own").alias("other"), F.col("source").alias("item")), 200, 16 << 20)
    return (one.unionByName(two).unionByName(three).groupBy("own", "other").agg(F.sum("v").alias("value"))
            .join(names, "own").join(items, "other").select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
          shard_terms: int = SHARD_TERMS, cell: int = CELL) -> DataFrame:
    """(lang, source, part, item, value, rank): of every source of a language
    its divergence from each other source (part ``pair``), and the terms it
    holds more of than its language (part ``term``, the first ``top_terms``)."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    docs = docs.select(text("lang"), text("source"), text("text"))
    counts, words = group_counts(docs, min_docs, shard_terms)
    sizes = words.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("size", zero).alias("size")))
    groups = cut_lineage(groups.withColumn("p0", share(zero, F.col("total"), F.col("size"))).withColumn("own", F.monotonically_increasing_id()))
    # rows of one language may be most of all: the small side is sent to them
    stats = fits_broadcast(groups, 200, 16 << 20)
    shares = cut_lineage(counts.join(stats, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("size")))
                         .select("lang", "own", "shard", "ix", "n", "p", "p0"))
    by_lang = groups.groupBy("lang", "size").agg(F.sum("total").alias("all"))
    whole = Window.partitionBy("lang", "shard", "ix")
    more = (shares.withColumn("whole", F.sum("n").over(whole)).join(fits_broadcast(by_lang, 100, 16 << 20), "lang")
            .withColumn("q", share(F.col("whole"), F.col("all"), F.col("size"))).where(F.col("p") > F.col("q"))
            .select("lang", "own", "shard", "ix", gap(F.col("p"), F.col("q")).alias("value")))
    # ties at the end are kept until the terms' names are there to break them
    near = more.withColumn("r", F.rank().over(Window.partitionBy("own").orderBy(F.desc("value")))).where(F.col("r") <= top_terms)
    names = fits_broadcast(groups.select("own", "source"), 200, 16 << 20)
    terms = near.join(words, ["lang", "shard", "ix"]).join(names, "own").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best))
    return ranked(_pairs(groups, shares, cell)).unionByName(ranked(terms).where(F.col("rank") <= top_terms))
