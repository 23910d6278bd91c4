"""WARC archives: writing pages as records, and reading records back.

Writing uses Spark's text sink with a blank line as separator, so files are
committed like any table's. Pages of equal payload become one response and
revisits of it; a Bloom filter of the repeated digests lets pages with a unique payload be written without a shuffle.

Reading deals each archive into byte ranges. A task finds each place of its
range where a record header stands and emits it as a candidate, with the offset
where its successor must begin. Magic inside a payload yields candidates too;
boundary-chain verification rejects them: every candidate points to the first
offset beyond its range that its chain reaches, pointer jumping doubles these
steps from the file's start, and only records on that chain are read. Payloads
are read (in pieces) for verified records alone.

Headers, of records and of HTTP blocks, may be of any length: the first
``HEAD`` bytes are read at once, longer ones to their blank line, as long as the
lines read are header lines.

Defined cases: a null payload counts as empty, a null URL leaves its header out, a null page_id is written without a number and read back as null. Of
repeated rows with the largest page_id of their payload each is a response.
Pages of equal payload without any page_id are all responses. An empty table
gives no record. Bytes behind a damaged record cannot be reached from the
file's start and are not returned; ``reach`` reports them per file.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bloom
from quarry.llm.common import cut_lineage

MAGIC = b"WARC/1."
END = "\r\n\r\n"
HEAD = 1 << 16
PIECE = 1 << 20
URN = "urn:page:"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: twenty bits, five hex
    digits, are four characters."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _records(rows: DataFrame, date: str) -> DataFrame:
    """One text per row of (page_id, url, html, digest, bytes, top): a record
    without the blank line behind it."""
    revisit = F.coalesce(F.col("page_id") != F.col("top"), F.col("top").isNotNull() & F.col("page_id").isNull())
    name = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    url = F.translate(F.col("url"), "\r\n", "")
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", name(F.col("top"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")))
    return rows.select(F.concat(head, F.lit("\r\n"), block).alias("value"))


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id",
          url: str = "url", html: str = "html") -> None:
    """Writes a record per page as WARC files in the folder ``path``. Payloads
    shorter than ``min_bytes`` are never revisits."""
    h = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), h.alias("html"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html").cast("long")})
    many = (rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
            .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("digest").alias("__digest"), "top"))
    many = cut_lineage(many)
    marked = bloom.flagged(rows, "digest", many, "__digest", many.count(), "__maybe")
    repeated = (marked.where("__maybe").join(many, F.col("digest") == F.col("__digest"), "left").drop("__digest")
                .withColumn("top", F.when(F.col("bytes") >= min_bytes, F.col("top"))))
    unique = marked.where("NOT __maybe").withColumn("top", F.lit(None).cast("long"))
    _records(repeated.unionByName(unique), date).write.option("lineSep", END).text(path)


def _open(path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return store.open_input_file(name)


_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*$", re.M)


def _fields(head: bytes) -> dict[str, str]:
    return {k.decode("latin-1").lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(head.replace(b"\r\n", b"\n"))}


_LINES = re.compile(rb"(?:WARC|HTTP)/[^\r\n]*\r\n(?:(?:[!-9;-~]+:|[ \t])[^\r\n]*\r\n)*")
VERSION_BYTES = len(b"WARC/1.0\r\n")
_VERSION = re.compile(rb"WARC/1\.\d\r\n")


def _header(f, head: bytes, at: int, end: int) -> bytes | None:
    """The header that begins at ``at`` with the bytes ``head``, without its
    blank line; read on, twice as far each time, until that line stands there.
    None if ``end`` or a line that is no header line comes first."""
    while (stop := head.find(b"\r\n\r\n")) < 0:
        if at + len(head) >= end:
            return None
        whole = head.rfind(b"\r\n") + 2 if len(head) >= HEAD else 0
        if whole and not _LINES.fullmatch(head, 0, whole):
            return None
        head += f.read_at(min(max(HEAD, len(head)), end - at - len(head)), at + len(head))
    return head[:stop]


def _candidates(f, start: int, end: int, length: int) -> list[tuple]:
    """(offset, successor, block start, fields) of the record headers that
    begin in [start, end)."""
    found = []
    data = f.read_at(min(length, end + len(MAGIC) - 1) - start, start)
    at = data.find(MAGIC)
    while at >= 0:
        off = start + at
        head = data[at:at + HEAD]
        if len(head) < VERSION_BYTES:
            head = f.read_at(min(HEAD, length - off), off)
        if _VERSION.match(head) and (head := _header(f, head, off, length)):
            fields = _fields(head)
            size = fields.get("content-length", "")
            if size.isdigit() and "warc-type" in fields:
                block = off + len(head) + 4
                # the blank line behind the block; some writers leave out the last
                succ = min(length, block + int(size) + 4)
                if block + int(size) <= length:
                    found.append((off, succ, block, int(size), fields))
        at = data.find(MAGIC, at + 1)
    return found


def candidates(files: DataFrame, range_bytes: int) -> DataFrame:
    """One row per record header in the archives (path, length): with its
    offset, its successor's, and ``jump``, the first offset outside its range
    that its chain reaches (null if the chain ends at no candidate)."""
    ranges = files.where("length > 0").select("path", "length", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("range"))
    n = files.select(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "length", "range", "off", "succ", "jump", "block", "size", "kind", "record", "refers", "digest"]
        for frame in frames:
            for path, length, start in frame.itertuples(index=False):
                end = min(length, start + range_bytes)
                with _open(path) as f:
                    found = _candidates(f, start, end, length)
                jump: dict[int, int | None] = {}
                for off, succ, *_ in reversed(found):
                    jump[off] = succ if succ >= end else jump.get(succ)
                out = [(path, length, start, off, succ, jump[off], block, size, x["warc-type"], x.get("warc-record-id"),
                        x.get("warc-refers-to"), x.get("warc-payload-digest")) for off, succ, block, size, x in found]
                pdf = pd.DataFrame(out, columns=names)
                yield pdf.astype(dict.fromkeys(("length", "range", "off", "succ", "jump", "block", "size"), "Int64"))

    schema = ("path string, length long, range long, off long, succ long, jump long, block long, size long, kind string, "
              "record string, refers string, digest string")
    found = ranges.repartition(int(min(n, 10_000)), "path", "range").mapInPandas(run, schema)
    return found.withColumn("file", F.xxhash64("path"))  # what joins carry instead of the path


def _entries(found: DataFrame, most_ranges: int) -> DataFrame:
    """(file, off) of the first record that the chain from the file's start
    meets in each range."""
    reached = cut_lineage(found.where("off = 0").select("file", "off"))
    # a pointer to the file's end has nothing to meet there
    jumps = found.where("jump < length").select("file", "off", F.col("jump").alias("to"))
    hops = 1
    while hops < most_ranges:
        far = reached.join(jumps, ["file", "off"]).select("file", F.col("to").alias("off"))
        reached = cut_lineage(reached.union(far).distinct())
        step = jumps.select("file", F.col("off").alias("to"), F.col("to").alias("next"))
        jumps = cut_lineage(jumps.join(step, ["file", "to"]).select("file", "off", F.col("next").alias("to")))
        hops *= 2
    return reached


def verified(found: DataFrame, most_ranges: int) -> DataFrame:
    """The candidates that the chain of record boundaries from the start of
    their file reaches."""
    entries = _entries(found, most_ranges).withColumn("entry", F.lit(True))
    flagged = found.select("file", "range", "off", "succ").join(entries, ["file", "off"], "left")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        succ = dict(zip(pdf["off"].tolist(), pdf["succ"].tolist(), strict=True))
        on = set()
        for at in pdf.loc[pdf["entry"].notna(), "off"].tolist():
            while at in succ and at not in on:
                on.add(at)
                at = succ[at]
        return pdf.loc[pdf["off"].isin(on), ["file", "range", "off"]]

    chain = flagged.groupBy("file", "range").applyInPandas(walk, "file long, range long, off long")
    return found.join(chain.select("file", "off"), ["file", "off"])


def _payload(f, block: int, size: int) -> tuple[int, dict[str, str]]:
    """Start of the payload in an HTTP block, and the HTTP fields."""
    head = f.read_at(min(size, HEAD), block)
    if not head.startswith(b"HTTP/"):
        return block, {}
    head = _header(f, head, block, block + size)
    if head is None:
        return block + size, {}
    return block + len(head) + 4, _fields(head)


def _found(spark: SparkSession, path: str, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The archives (path, length) in a folder, and their verified records."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    most = files.agg(F.max(F.ceil(F.col("length") / range_bytes))).first()[0] or 0
    return files, verified(cut_lineage(candidates(files, range_bytes)), most)


def reach(spark: SparkSession, path: str, range_bytes: int = 8 << 20) -> DataFrame:
    """(path, length, records, reached, lost) of each archive in a folder: its
    verified records, the offset up to which the chain of records leads from its
    start, and the bytes behind that, which ``read`` cannot return."""
    files, good = _found(spark, path, range_bytes)
    ends = good.groupBy("path").agg(F.count(F.lit(1)).alias("records"), F.max("succ").alias("reached"))
    zero = F.lit(0).cast("long")
    return (files.join(ends, "path", "left").select("path", "length", F.coalesce("records", zero).alias("records"), F.coalesce("reached", zero).alias("reached"))
            .withColumn("lost", F.col("length") - F.col("reached")))


def read(spark: SparkSession, path: str, range_bytes: int = 8 << 20, with_payload: bool = False) -> DataFrame:
    """The records of the uncompressed archives in the folder ``path``:
    record_type, page_id, refers_to (from the record names that ``write``
    gives), payload_bytes and payload_digest (of the full payload; of a
    revisit, those that its headers state), and the payload itself if asked
    for. Archives must be where pyarrow's file systems reach."""
    good = _found(spark, path, range_bytes)[1].select("path", "range", "off", "block", "size", "kind", "record", "refers", "digest")

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = lambda x: int(m[1]) if x and (m := re.fullmatch(rf"<{URN}(-?\d+)>", x)) else None
        names = ["record_type", "page_id", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * with_payload
        for frame in frames:
            out = []
            for name, rows in frame.groupby("path", sort=False):
                with _open(name) as f:
                    for r in rows.itertuples(index=False):
                        start, http = _payload(f, r.block, r.size)
                        stated = (r.digest or "").removeprefix("sha1:")
                        if r.kind == "revisit":
                            length = http.get("content-length", "")
                            row = [int(length) if length.isdigit() else 0, stated]
                            data = None
                        else:
                            end, sha, kept = r.block + r.size, hashlib.sha1(), []
                            for at in range(start, end, PIECE):
                                part = f.read_at(min(PIECE, end - at), at)
                                sha.update(part)
                                if with_payload:
                                    kept.append(part)
                            row = [end - start, base64.b32encode(sha.digest()).decode()]
                            data = b"".join(kept)
                        out.append([r.kind, number(r.record), number(r.refers), *row] + [data] * with_payload)
            yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "record_type string, page_id long, refers_to long, payload_bytes long, payload_digest string" + ", payload binary" * with_payload
    dealt = good.repartition("path", "range").sortWithinPartitions("path", "off")
    return dealt.mapInPandas(run, schema)
