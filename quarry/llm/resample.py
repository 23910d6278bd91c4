"""Importance resampling of a corpus towards a target distribution.

Features are runs of one to three consecutive words, hashed into ``BUCKETS``
buckets. Every task counts its buckets in one array and emits it once, so a
bucket that holds a third of all features is summed before the shuffle. The
gain of a bucket compares the target's share with the corpus's; the gains are
one array of ``BUCKETS`` numbers, whatever the size of the corpus, and score
every document as a sum of look-ups.

The draw is the first k rows by a composite key (score descending, then id,
then row). ``kth_key`` finds the k-th key without a sort: random rows of the
range still open are pivots, one aggregate counts the rows below and at each
of them exactly, and the range shrinks to two neighbouring pivots until a
pivot is the key. Only the winners are sorted, by range, and ranked by their
place in their range plus the rows of the ranges before.

Defined cases: a null or empty text has no word, weight 0, and is not drawn.
Null ids come after all others on ties; their noise is that of the empty
string. Repeated rows are scored and drawn as rows of their own; rows with
equal key columns are told apart by the number they get when the scores are
written. Empty tables give no draw, an empty target gains from the smoothing
alone. Long texts are read in pieces, so a worker holds a piece's words, not a
text's. Only the id and text columns are read.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage

BUCKETS = 10_000
MAX_RUN = 3
SEED = 42
#: Random pivots a round of the selection; the open range shrinks about so many times.
PIVOTS = 15
#: Bytes of a text whose words are held at once.
PIECE = 1 << 20

# Words are digits, letters and all beyond ASCII; A-Z count as a-z.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _pieces(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text in order, a list for every ``size`` bytes or so."""
    at, tail = 0, b""
    while at < len(text):
        part = tail + text[at:at + size].lower()
        at += size
        words = _WORD.findall(part)
        # a word that touches the end may go on in the next piece
        tail = words.pop() if at < len(text) and words and part.endswith(words[-1]) else b""
        yield words
    if tail:
        yield [tail]


def features(text: bytes | None, size: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """Per piece of a text: its number of words, and the bucket of every run
    of up to ``MAX_RUN`` words that ends in the piece.

    The checksum of a run goes on from that of the run without its last word,
    so every run costs one call on one word."""
    before: list[list[int]] = [[] for _ in range(MAX_RUN)]  # last checksum of each run length
    for words in _pieces(text or b"", size):
        if not words:
            continue
        spaced = [b" " + w for w in words]
        runs = [list(map(zlib.crc32, words))]
        for n in range(1, MAX_RUN):
            head = before[n - 1] + runs[n - 1]
            start = len(words) - (len(head) - 1)  # words without a run of n words before them
            runs.append(list(map(zlib.crc32, spaced[max(0, start):], head)))
        before = [(b + r)[-1:] for b, r in zip(before, runs, strict=True)]
        every = np.fromiter(itertools.chain.from_iterable(runs), np.int64, sum(map(len, runs)))
        yield len(words), every % BUCKETS


def bucket_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): occurrences of each bucket's features in all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for _, buckets in features(value.as_py()):
                    total += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    parts = df.select(F.col(text).cast("binary")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, text: str = "text") -> list[int]:
    """The gain of every bucket: floor of 1000 times the log ratio of its
    smoothed shares in ``target`` and ``raw``."""

    def counts(df: DataFrame) -> list[int]:
        out = [0] * BUCKETS
        for r in bucket_counts(df, text).collect():  # at most BUCKETS rows
            out[r["bucket"]] = r["n"]
        return out

    s, t = counts(raw), counts(target)
    s_all, t_all = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return [math.floor(1000 * math.log((b + 1) * s_all / ((a + 1) * t_all))) for a, b in zip(s, t, strict=True)]


def score(docs: DataFrame, gain: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(gain, np.int64)
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, doc in enumerate(batch.column(1)):
                for n, buckets in features(doc.as_py()):
                    out[:, i] += (n, len(buckets), value[buckets].sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.withColumn("score", F.col("weight") + noise)


def _key(cols: list[str], row: Row | None = None) -> Column:
    """The key columns, or one row's values of them, as one comparable value."""
    return F.struct(*[(F.col(c) if row is None else F.lit(row[c]).cast("long")).alias(c) for c in cols])


def kth_key(df: DataFrame, cols: list[str], k: int, pivots: int = PIVOTS) -> Row | None:
    """The k-th smallest row of ``df`` by the long columns ``cols``, whose
    values together must differ between rows and not be null; None if there
    are fewer rows. Each round moves ``pivots`` rows and one row of counts."""
    key, low, high, before = _key(cols), None, None, 0
    for step in itertools.count():
        part = df.select(*cols)
        if low is not None:
            part = part.where(key > _key(cols, low))
        if high is not None:
            part = part.where(key < _key(cols, high))
        sample = part.orderBy(F.xxhash64(F.lit(step), *cols)).limit(pivots).collect()
        marks = sorted(sample, key=tuple)
        if not marks:
            return None
        counts = part.agg(F.count(F.lit(1)).alias("all"), *[
            F.struct(F.count_if(key < _key(cols, p)).alias("below"), F.count_if(key == _key(cols, p)).alias("at")).alias(f"p{i}")
            for i, p in enumerate(marks)]).first()
        if low is None and high is None and counts["all"] < k:
            return None
        for i, p in enumerate(marks):
            below, at = counts[f"p{i}"]
            if before + below < k <= before + below + at:
                return p
            if k <= before + below:
                high, lower = p, marks[i - 1] if i else None
                break
        else:
            lower = marks[-1]
        if lower is not None:
            i = marks.index(lower)
            before, low = before + sum(counts[f"p{i}"]), lower


def ranked(df: DataFrame, cols: list[str], rank: str = "rank") -> DataFrame:
    """``df`` with each row's place (from 1) in the order of ``cols``: sorted
    by ranges; a row's place is that in its range plus the rows of the ranges
    before, of which there are no more than partitions of a shuffle."""
    parts = cut_lineage(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(parts.groupBy(part.alias("part")).count().collect())
    starts = dict(zip([r["part"] for r in sizes], itertools.accumulate((r["count"] for r in sizes), initial=0), strict=False))
    if not starts:
        return parts.withColumn(rank, F.lit(None).cast("long")).drop("__at")
    first = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
    return parts.withColumn(rank, (F.element_at(first, part) + place + 1).cast("long")).drop("__at")


def draw(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """Every row of ``scored`` with ``rank``: its place among the drawn rows,
    ``percent`` of those with at least ``min_words`` words, or null."""
    cols = ["__score", "__none", "__id", "__row"]
    rows = cut_lineage(scored.withColumns({
        "__score": -F.col("score"), "__none": F.col("doc_id").isNull().cast("long"),
        "__id": F.coalesce("doc_id", F.lit(0).cast("long")), "__row": F.monotonically_increasing_id()}))
    able = F.col("n_words") >= min_words
    k = percent * rows.where(able).count() // 100
    last = kth_key(rows.where(able), cols, k) if k else None
    won = able & (_key(cols) <= _key(cols, last)) if last else F.lit(False)
    lost = rows.where(~won).withColumn("rank", F.lit(None).cast("long"))
    return (ranked(rows.where(won), cols).unionByName(lost) if last else lost).drop(*cols)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document."""
    return draw(score(docs, gains(docs, target)), percent, min_words)
