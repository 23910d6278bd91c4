"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check.

A fingerprint has 64 bits, cut into six blocks. Two fingerprints that differ in
at most three bits agree in three blocks at least, so for each of the twenty
choices of three blocks the fingerprints are dealt out by the bits of these
blocks, and only fingerprints of one bucket are compared. Equal fingerprints
are merged first. A bucket yields a spanning set of links, not all its pairs:
the search goes from linked to not yet linked fingerprints and stops when all
are linked.

A bucket of more than ``max_bucket`` different fingerprints is not held in
memory. Its fingerprints are first linked to a few pivots; if they are not all
one component then, the bucket is dealt out anew by each quarter of its free
bits, one of which must agree too, until every bucket fits. That loses no link.

Defined cases: a null text has no words and fingerprint zero, as has an empty
one; both link like any other. Repeated rows share fingerprint and component.
A null id never is a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, hashed_key, map_frames
from quarry.llm.components import connected_components

SEED = 42
#: Bits of the six blocks, lowest first.
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
MAX_BUCKET = 16384
PIVOTS = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text's word shingles, repeats included, as unsigned 64 bits."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    h = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [h(joined, SEED)]
    else:
        hashes = [h(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=False)]
    n, counts = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory whatever the text's length
        part = np.array(hashes[at:at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, k1, k2, fp): fp is the fingerprint as a signed long, k1 and k2
    the row's key."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.fromiter((fingerprint(t, shingle) for t in pdf.pop("t")), np.uint64, len(pdf))
        return pdf.assign(fp=fp.view(np.int64))

    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.col(text).alias("t"))
    return map_frames(rows, run, "doc_id long, k1 long, k2 long, fp long")


def block_masks(agree: int = 3) -> list[int]:
    """Bit masks of every choice of ``agree`` blocks."""
    blocks, low = [], 0
    for bits in BLOCK_BITS:
        blocks.append(((1 << bits) - 1) << low)
        low += bits
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _spanning(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what max_bits joins among different fingerprints."""
    rest, us, vs = fp, [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                us.append(np.full(len(found), at))
                vs.append(found)
                queue.extend(found)
    none = np.empty(0, np.uint64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _link_buckets(max_bits: int, max_bucket: int):
    """Over (mask, key, fp) sorted by all three: links as (u, v), and the rows
    of buckets above max_bucket as (mask, key, fp)."""
    columns = ["u", "v", "mask", "key", "fp"]

    def links(us, vs):
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        return pd.DataFrame({"u": u, "v": v}).drop_duplicates().reindex(columns=columns).astype("Int64")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None  # the rows of the bucket that may go on
        hot: tuple | None = None  # the bucket that is too large to hold
        for frame in frames:
            if not len(frame):
                continue
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            m, k, fp = (frame[c].to_numpy() for c in ("mask", "key", "fp"))
            fp = fp.view(np.uint64)
            edge = np.flatnonzero((m[1:] != m[:-1]) | (k[1:] != k[:-1])) + 1
            starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(frame)]))
            us, vs = [], []
            last = int(starts[-1])
            for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
                if a == last:
                    break
                if b - a == 2:
                    if int(fp[a] ^ fp[a + 1]).bit_count() <= max_bits and (m[a], k[a]) != hot:
                        us.append(fp[a:a + 1])
                        vs.append(fp[a + 1:b])
                elif b - a <= max_bucket and (m[a], k[a]) != hot:
                    u, v = _spanning(fp[a:b], max_bits)
                    us.append(u)
                    vs.append(v)
            if us:
                yield links(us, vs)
            parts = []
            large = ends - starts > max_bucket
            large[0] |= (m[0], k[0]) == hot  # only the first bucket can go on from the last frame
            for i in np.flatnonzero(large):
                parts.append(frame.iloc[starts[i]:ends[i]])
                hot = (m[starts[i]], k[starts[i]])
            if parts:
                yield pd.concat(parts).reindex(columns=columns).astype("Int64")
            held = frame.iloc[last:] if (m[last], k[last]) != hot else None
        if held is not None and len(held) > 1:
            us, vs = _spanning(held["fp"].to_numpy().view(np.uint64), max_bits)
            if len(us):
                yield links([us], [vs])

    return run


def _compare(keyed: DataFrame, max_bits: int, max_bucket: int) -> tuple[DataFrame, DataFrame]:
    """Links and rows of too large buckets of (mask, key, fp)."""
    dealt = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    out = cut_lineage(dealt.mapInPandas(_link_buckets(max_bits, max_bucket), "u long, v long, mask long, key long, fp long"))
    return out.where("u IS NOT NULL").select("u", "v"), out.where("u IS NULL").select("mask", "key", "fp")


def _by_masks(fps: DataFrame, masks: list[int]) -> DataFrame:
    every = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    return (fps.select("fp", F.explode(every).alias("mask"))
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))


def _quarters(mask: int) -> list[int]:
    """``mask`` with each quarter of its free bits added."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(free) * q // 4 for q in range(5)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _still_apart(hot: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of those buckets whose fingerprints are not all linked yet."""
    root = connected_components(links)
    rooted = (hot.join(root, hot["fp"] == root["u"], "left")
              .select("mask", "key", "fp", F.coalesce("v", "fp").alias("root")))
    apart = rooted.groupBy("mask", "key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    return hot.join(apart.select("mask", "key"), ["mask", "key"], "left_semi")


def link_fingerprints(fps: DataFrame, max_bits: int = 3, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(u, v) links that join all fingerprints (distinct column fp) at
    ``max_bits`` or fewer differing bits into their components."""
    if not 0 <= max_bits <= 3:
        raise ValueError("six blocks of which three agree allow for at most 3 differing bits")
    links, hot = _compare(_by_masks(fps, block_masks()), max_bits, max_bucket)
    while not hot.isEmpty():
        picks = [F.min(F.struct(F.xxhash64(F.lit(i), "fp"), "fp")).alias(f"p{i}") for i in range(PIVOTS)]
        pivots = hot.groupBy("mask", "key").agg(*picks).select(
            "mask", "key", F.explode(F.array_distinct(F.array(*[F.col(f"p{i}.fp") for i in range(PIVOTS)]))).alias("p"))
        star = (hot.join(pivots, ["mask", "key"])
                .where((F.col("fp") != F.col("p")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("p"))) <= max_bits))
                .select(F.col("fp").alias("u"), F.col("p").alias("v")))
        links = cut_lineage(links.union(star).distinct())
        hot = cut_lineage(_still_apart(hot, links))
        masks = [r["mask"] for r in hot.select("mask").distinct().collect()]  # at most 20 * 4 ** round
        finer = [(m, q) for m in masks for q in _quarters(m & (1 << 64) - 1)]
        if not finer:
            break
        pairs = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(_signed(q)).alias("q")) for m, q in finer])
        keyed = (hot.select("mask", "fp", F.explode(pairs).alias("x")).where("mask = x.m")
                 .select(F.col("x.q").alias("mask"), F.col("fp").bitwiseAND(F.col("x.q")).alias("key"), "fp").distinct())
        more, hot = _compare(keyed, max_bits, max_bucket)
        links = links.union(more)
    return links


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3,
               max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, k1, k2 (row key), fp (signed long),
    root (smallest fingerprint of the component) and component_id (smallest
    doc_id)."""
    prints = cut_lineage(fingerprints(docs, doc_id, text, shingle))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    root = connected_components(link_fingerprints(distinct.select("fp"), max_bits, max_bucket))
    rooted = (distinct.join(root, distinct["fp"] == root["u"], "left")
              .select("fp", "least", F.coalesce("v", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id
    (null ids last), of equal ids one of them."""
    found = cut_lineage(components(docs, doc_id, text, shingle, max_bits))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    keepers = found.groupBy("root").agg(F.min(order).alias("x")).select(F.col("x.k1").alias("__k1"), F.col("x.k2").alias("__k2"))
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    rows = docs.withColumns({"__k1": k1, "__k2": k2}).join(keepers, ["__k1", "__k2"], "left_semi")
    return rows.dropDuplicates(["__k1", "__k2"]).drop("__k1", "__k2")
