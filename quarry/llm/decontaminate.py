"""Benchmark decontamination by spaced-seed hashing.

A mask selects some positions of a short span of words and ignores the others;
the hash of the selected words is a seed. Seeds of the test items are joined
with seeds of the documents, and around each hit the words of both sides are
compared in place: an overlap counts if a window of ``WINDOW`` aligned words
differs in at most ``SUBSTITUTIONS`` of them.

The three masks are lossless for that test: whichever two words of thirteen are
replaced, one of the masks fits somewhere between them. Items of 5 to 12 words
must occur whole with at most one word replaced (one mask for each omitted
word). Shorter items are ordinary phrases: they are searched only if the caller
lowers ``min_words``, and then must occur whole and unchanged. Equal items are
searched once.

The test side is dealt into chunks of at most ``chunk_bytes`` by its measured
size; each chunk is broadcast in turn and the documents are scanned once per
chunk, so documents never are shuffled and memory stays bounded.

Defined cases: null or wordless texts on either side match nothing; equal items
are reported each by its own id (a null id too), or with ``expand=False`` once,
by their least id and number; documents with null or
repeated ids are reported one row each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hashed_key, map_frames

WINDOW = 13
SUBSTITUTIONS = 2
MIN_WORDS = 5

#: Weight seven. Found by search: together they meet every pair of replaced words in a window of thirteen.
MASKS = ((0, 1, 2, 3, 5, 6, 7), (0, 1, 4, 7, 8, 9, 10), (0, 1, 2, 3, 4, 5, 7))

FILTER_BITS = 22  # of the bitmap that is tried before the sorted seeds: 4 MB as bytes
BATCH_WORDS = 1 << 20

_WORD = re.compile(r"\w+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165,
                 0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0xAEF17502108EF2D9], np.uint64)


def word_ids(text: str | None) -> np.ndarray:
    """64-bit hashes of the lower-cased words of a text (letters, digits and
    underscores; punctuation does not count)."""
    found = _WORD.findall((text or "").lower())
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w) for w in found), np.uint64, len(found))


def _seed(ids: np.ndarray, mask: tuple[int, ...], at: int) -> np.ndarray:
    """Seeds of mask number ``at`` at every place of ids that it fits."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, (at + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1, np.uint64)
    for i, p in enumerate(mask):
        x = ids[p:p + n] * _MIX[i]
        out ^= x ^ (x >> np.uint64(29))
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(31))


class Seeds:
    """Seeds of a chunk of test items; what is broadcast."""

    def __init__(self, ids: list[tuple], texts: list[str | None], min_words: int = MIN_WORDS):
        items = [(i, w) for i, w in zip(ids, map(word_ids, texts), strict=True) if len(w) >= max(min_words, 1)]
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        lengths = [len(w) for w in self.words]
        self.masks = list(MASKS)
        short = {}  # length: numbers of its masks
        for n in sorted({x for x in lengths if x < WINDOW}):
            masks = [tuple(p for p in range(n) if p != out) for out in range(n)] if n >= MIN_WORDS else [tuple(range(n))]
            short[n] = range(len(self.masks), len(self.masks) + len(masks))
            self.masks += masks
        seeds, item, place = [], [], []
        for k, w in enumerate(self.words):
            for at in short.get(len(w), range(len(MASKS))):
                # a mask that omits the first word of a short item starts at its second
                s = _seed(w, self.masks[at], at)
                s = s[:1] if len(w) < WINDOW else s
                seeds.append(s)
                item.append(np.full(len(s), k))
                place.append(np.arange(len(s)))
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
        seeds = join(seeds, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], join(item, np.int64)[order], join(place, np.int64)[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Rows (item, shift): item k's word q stands at word q + shift."""
        found = []
        for at, mask in enumerate(self.masks):
            s = _seed(words, mask, at)
            p = np.flatnonzero(self.filter[(s >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(self.seeds, s[p], "left"), np.searchsorted(self.seeds, s[p], "right")
            n = hi - lo
            if n.any():
                rows = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                found.append(np.stack([self.item[rows], np.repeat(p, n) - self.place[rows]], axis=1))
        return np.concatenate(found) if found else np.empty((0, 2), np.int64)

    def overlaps(self, words: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """(start, end, equal) of the part of the document that item covers at
        this shift, from the first to the last good window; None without any."""
        w = self.words[item]
        need = min(WINDOW, len(w))
        allowed = SUBSTITUTIONS if len(w) >= WINDOW else 1 if len(w) >= MIN_WORDS else 0
        a, b = max(0, -shift), min(len(w), len(words) - shift)
        if b - a < need:
            return None
        equal = w[a:b] == words[a + shift:b + shift]
        sums = np.concatenate(([0], np.cumsum(equal)))
        good = np.flatnonzero(sums[need:] - sums[:-need] >= need - allowed)
        if not len(good):
            return None
        first, last = int(good[0]), int(good[-1]) + need
        return a + shift + first, a + shift + last, int(sums[last] - sums[first])


def _chunks(items: DataFrame, chunk_bytes: int, min_words: int) -> Iterator[Seeds]:
    """The different test items (c1, c2, i, n, t) in parts whose words and
    seeds take about chunk_bytes."""
    chars = items.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    n = 1 + int(chars * 40 // chunk_bytes)  # a word of two characters: 8 bytes, and three seeds of 24
    for part in range(n):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(n)) == part).collect()
        rows.sort(key=lambda r: (r["i"] is None, r["i"], r["t"] or ""))
        yield Seeds([(r["i"], r["n"], r["c1"], r["c2"]) for r in rows], [r["t"] for r in rows], min_words)


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", chunk_bytes: int = 64 << 20, min_words: int = MIN_WORDS, expand: bool = True) -> DataFrame:
    """One row per document and test item that overlap: doc_id, item_id,
    start_word, end_word (of the document, end exclusive, the widest of several
    places), n_equal (equal words there), item_words; and k1, k2, the row's key.
    Without ``expand`` one row per document and class of equal items: item_id is
    its least id, n_items its number of items."""
    c1, c2 = hashed_key(F.col(item_text))
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"), c1.alias("c1"), c2.alias("c2"))
    classes = items.groupBy("c1", "c2", "t").agg(F.min("i").alias("i"), F.count(F.lit(1)).alias("n"))
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.col(text).alias("t"))
    schema = "doc_id long, k1 long, k2 long, item_id long, n_items long, c1 long, c2 long, start_word long, end_word long, n_equal long, item_words long"
    names = [f.split()[0] for f in schema.split(", ")]
    spark = docs.sparkSession
    out = None
    for seeds in _chunks(classes, chunk_bytes, min_words):
        sent = spark.sparkContext.broadcast(seeds)

        def run(pdf: pd.DataFrame, sent=sent) -> pd.DataFrame:
            s, found = sent.value, []
            for doc, a, b, t in pdf.itertuples(index=False):
                words = word_ids(t)
                best = {}
                tried = set()
                # a very long text in parts that share a span, so that memory stays bounded
                for at in range(0, len(words), BATCH_WORDS):
                    hits = s.hits(words[at:at + BATCH_WORDS + WINDOW])
                    for k, shift in (np.unique(hits, axis=0) + [0, at]).tolist():
                        if (k, shift) not in tried:
                            tried.add((k, shift))
                            x = s.overlaps(words, k, shift)
                            if x and (x[2], -x[0]) > (best[k][2], -best[k][0]) if k in best else x:
                                best[k] = x
                found += [(doc, a, b, *s.ids[k], *x, len(s.words[k])) for k, x in sorted(best.items())]
            return pd.DataFrame(found, columns=names).astype(dict.fromkeys(names, "Int64"))

        part = map_frames(rows, run, schema)
        out = part if out is None else out.unionByName(part)
    if not expand:
        return out.drop("c1", "c2")
    every = items.select("c1", "c2", F.col("i").alias("item_id"))
    return out.drop("item_id", "n_items").join(every, ["c1", "c2"]).select(*[c for c in names if c not in ("n_items", "c1", "c2")])


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap a test item."""
    from quarry.llm.common import cut_lineage, fits_broadcast

    bad = cut_lineage(matches(docs, benchmark, doc_id, text, expand=False).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct())
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    return (docs.withColumns({"__k1": k1, "__k2": k2})
            .join(fits_broadcast(bad, 64, 16 << 20), ["__k1", "__k2"], "left_anti").drop("__k1", "__k2"))
