"""Blocked Bloom filter as a small table, built and probed by DataFrame
operations only.

A key's 64-bit hash picks one block of eight 64-bit words; eight six-bit
slices of a second hash pick one bit in each word. The filter is a table
``(block, w0..w7)`` of at most ``SPAN * MAX_BLOCKS`` rows, so it may always be
broadcast. More keys than fill one such table are dealt into shards by a third
hash: each shard has a filter of its own, which only the rows whose key falls
into that shard meet, so the share of false positives does not grow with the
number of keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage

MAX_BLOCKS = 1 << 16  # 4 MB of bits
SPAN = 8  # a table has at most eight times that: 16.7 million keys, 32 MB of bits
KEYS_PER_BLOCK = 32
WORDS = 8


def _bits(key: Column) -> list[Column]:
    spread = F.xxhash64(F.lit("bits"), key)
    return [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def build(keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """The filter of column ``key`` and its number of blocks. ``n_keys`` is the
    expected number of distinct keys; nulls are left out."""
    n_blocks = max(1, min(SPAN * MAX_BLOCKS, math.ceil(n_keys / KEYS_PER_BLOCK)))
    k = F.col(key)
    bits = _bits(k)
    one = F.lit(1).cast("long")
    words = [F.call_function("shiftleft", one, b).alias(f"w{i}") for i, b in enumerate(bits)]
    rows = keys.where(k.isNotNull()).select(_block(k, n_blocks).alias("block"), *words)
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), n_blocks


def probe(df: DataFrame, key: str, filter_: tuple[DataFrame, int], flag: str) -> DataFrame:
    """``df`` with boolean ``flag``: false means that the key is certainly not
    among the filter's keys."""
    blocks, n_blocks = filter_
    k = F.col(key)
    names = {f"w{i}": f"__w{i}" for i in range(WORDS)} | {"block": "__block"}
    side = F.broadcast(blocks.select(*[F.col(a).alias(b) for a, b in names.items()]))
    hit = F.col("__block").isNotNull()
    for i, b in enumerate(_bits(k)):
        hit = hit & (F.call_function("shiftrightunsigned", F.col(f"__w{i}"), b).bitwiseAND(F.lit(1)) == 1)
    probed = df.withColumn("__at", _block(k, n_blocks)).join(side, F.col("__at") == F.col("__block"), "left")
    return (probed.withColumn(flag, F.coalesce(hit & k.isNotNull(), F.lit(False)))
            .drop("__at", *names.values()))


def flagged(df: DataFrame, key: str, keys: DataFrame, listed: str, n_keys: int, flag: str) -> DataFrame:
    """``df`` with boolean ``flag``: false means that its ``key`` is certainly
    not among the ``n_keys`` keys of column ``listed`` of ``keys``.

    Keys for one table take one pass. With more, every shard takes a pass over
    its own rows, which is written before the next, so that one filter at a time
    is broadcast; each row is in exactly one pass."""
    shards = max(1, math.ceil(n_keys / (SPAN * MAX_BLOCKS * KEYS_PER_BLOCK)))
    if shards == 1:
        return probe(df, key, build(keys, listed, n_keys), flag)

    def of(c: str, shard: int) -> Column:
        return F.pmod(F.xxhash64(F.lit("shard"), F.col(c)), F.lit(shards)) == shard

    keys, out = cut_lineage(keys.select(listed)), None
    for s in range(shards):
        filter_ = build(keys.where(of(listed, s)), listed, math.ceil(n_keys / shards))
        part = cut_lineage(probe(df.where(of(key, s)), key, filter_, flag))
        out = part if out is None else out.unionByName(part)
    return out
