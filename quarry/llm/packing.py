"""Packing of token sequences by best-fit decreasing.

Texts longer than a window are cut into full windows first; each of these is a
sequence by itself. The rests are dealt into shards of about ``shard_pieces``
pieces, and each shard is packed longest first: a segment tree over the
remaining capacities finds the open sequence with the least room that still
fits. The shards' number follows the number of pieces, so a task's memory is
bounded; a shard leaves a handful of part-filled sequences.

Tokens never are shuffled unless asked for: tokenising writes one short row
per piece to the shared folder, and these are packed.

Defined cases: a null text counts as empty and has the end token alone. Rows
with null or repeated ids are packed as rows of their own. Ties go by the
row's key. An empty table packs into nothing.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, hashed_key

#: Chunks in a generation of a worker's cache.
CACHE = 400_000
#: Rows and bytes of text that are encoded together.
ROWS, TEXT_BYTES = 2048, 8 << 20
PIECES = "doc_id long, k1 long, k2 long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Ids of whole texts by the ``tokenizers`` library, as little-endian
    32-bit words.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its white-space separated chunks. Chunks seen before come from a
    cache of bounded size: two generations, of which the older one goes when
    the younger is full. Only ASCII white space separates, which the tokenizer
    counts as white space too. New chunks are encoded as they are, but for those
    made of Latin letters and then ASCII punctuation without an apostrophe:
    the tokenizer lower-cases the letters, cuts between the two, and hands each
    part's bytes, spelled by the byte-level alphabet, to its model. The same is
    done here, so that the many forms of a word share the model's work."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        self.tokenize = tokenizer.model.tokenize
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # every byte that two-byte characters are made of, spelled by the alphabet
        self.spelling = {b: spell(bytes([b]).decode())[0][0] for b in range(0x21, 0x7F)}
        for c in map(chr, range(0xC0, 0x100)):
            self.spelling |= dict(zip(c.encode(), spell(c)[0][0], strict=True))
        self.plain = re.compile(r"([A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """Ids of letters or of punctuation, lower case; a chunk of its own."""
        ids = self.young.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is None:
                spelled = part.encode().decode("latin-1").translate(self.spelling)
                x = [t.id for t in self.tokenize(spelled)]
                ids = struct.pack(f"<{len(x)}I", *x)
            self.young[part] = ids
        return ids

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of these chunks."""
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        young, old, plain, odd = self.young, self.old, self.plain, []
        for c in chunks:
            if c in young:
                continue
            ids = old.get(c)
            if ids is not None:
                young[c] = ids
            elif m := plain(c):
                letters, rest = m.groups()
                low = letters.lower()
                ids = self._part(c if low == c else low)
                if low != c:
                    young[c] = ids + self._part(rest) if rest else ids
            else:
                odd.append(c)
        for at in range(0, len(odd), 4096):
            part = odd[at:at + 4096]
            for c, e in zip(part, self.encode(part, add_special_tokens=False), strict=True):
                young[c] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return [young[c] for c in chunks]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none null) one behind the other, and where each
        text's begin, with the end of the last. Chunks are numbered by Arrow,
        each different one is looked up once, and ids are gathered by number."""
        lists = pc.ascii_split_whitespace(texts)
        found = lists.flatten().dictionary_encode()
        number = found.indices.to_numpy(zero_copy_only=False)
        parts = self._ids(found.dictionary.to_pylist())
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        table = np.frombuffer(b"".join(parts), "<u4")
        n = size[number]
        ends = np.concatenate(([0], np.cumsum(n)))
        place = np.repeat((np.cumsum(size) - size)[number] - ends[:-1], n) + np.arange(ends[-1])
        chunks = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
        return table[place], ends[chunks]


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each file and worker process, whose tasks share its cache."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, doc_id: str = "doc_id",
           text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, row key, start, length, crc32 of its ids as
    little-endian 32-bit words, doc_tokens; with its ids too if asked for.
    ``tokenizer``: a file of the ``tokenizers`` library, on every node."""
    k1, k2 = hashed_key(F.col(doc_id), F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        encode, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # rows of about so many bytes at a time, one at least
                size = pc.binary_length(batch.column("t").slice(at, ROWS)).to_numpy(zero_copy_only=False)
                take = max(1, int(np.searchsorted(np.cumsum(size), TEXT_BYTES, "right")))
                part, at = batch.slice(at, take), at + take
                ids, bounds = encode(part.column("t"))
                row, start, length, crc, total, kept = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    n = b - a + 1  # with the end token
                    for s in range(0, n, window):
                        x = ids[a + s:min(a + s + window, b)].tobytes()
                        x = x + end if s + window >= n else x
                        row.append(i)
                        start.append(s)
                        length.append(len(x) // 4)
                        crc.append(zlib.crc32(x))
                        total.append(n)
                        if with_ids:
                            kept.append(np.frombuffer(x, "<u4").tolist())
                mine = [part.column(c).take(pa.array(row, pa.int64())) for c in ("doc_id", "k1", "k2")]
                columns = mine + [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                names = [c.split()[0] for c in PIECES.split(", ")]
                if with_ids:
                    columns, names = [*columns, pa.array(kept, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, PIECES + ", ids array<long>" * with_ids)


class Room:
    """Open sequences by remaining capacity: leaf c of a segment tree tells
    how many have c tokens of room, an inner node how many lie below it."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out (room, sequence) of the least room of at least need."""
        count, i = self.count, need + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up to where a right neighbour has some
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:  # and down to its leftmost
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._change(room, -1)
        return room, self.open[room].pop()

    def _change(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each length; lengths must be decreasing."""
    room, sequences, offsets, n = Room(window), [], [], 0
    for x in lengths:
        found = room.tightest(x) if x < window else None
        if found is None:
            found, n = (window, n), n + 1
        left, sequence = found
        sequences.append(sequence)
        offsets.append(window - left)
        if left > x:
            room.add(left - x, sequence)
    return sequences, offsets


def pack(cut: DataFrame, window: int = 2048, shard_pieces: int = 50_000) -> DataFrame:
    """Pieces with sequence_id (shard in the high 32 bits) and offset."""
    cut = cut_lineage(cut)
    shards = 1 + cut.count() // shard_pieces

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "k1", "k2", "start"], ascending=[False, True, True, True], kind="stable")
        sequences, offsets = best_fit(pdf["length"].tolist(), window)
        shard = pdf.pop("shard")
        return pdf.assign(sequence_id=np.array(sequences, np.int64) + (shard.to_numpy() << 32), offset=np.array(offsets, np.int64),
                          doc_id=pdf["doc_id"].astype("Int64"))

    # by place in the written table: equal rows do not meet in one shard
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInPandas(run, schema)
