import base64
import hashlib
import uuid

import pytest

from quarry.llm import warc as W
from quarry.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, top long"
FAKE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nWARC-Payload-Digest: sha1:X\r\n"
        "Content-Length: 12\r\n\r\nhello, world\r\n\r\n")


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 5) for i, u, h in rows], PAGES)


def round_trip(spark, rows, range_bytes=1 << 20, files=3, **kw):
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    W.write(pages_of(spark, rows).repartition(files), path, **kw)
    return W.read(spark, path, range_bytes, with_payload=True).collect()


def brute(rows, min_bytes=0):
    top = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= min_bytes:
            d = digest(h)
            top[d] = max((x for x in (top.get(d), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        d = digest(h)
        n = len((h or "").encode())
        revisit = n >= min_bytes and top.get(d) is not None and i != top[d]
        out.append((i, n, d, "revisit" if revisit else "response", top[d] if revisit else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", "<p>same</p>"), (4, "u", None), (5, "u", ""),
        (6, "u", FAKE), (7, "u", "text " + FAKE + FAKE + " more"), (8, "u", "é ü \U0001F600 \r\n\r\n WARC/1.0\r\n"), (9, "u", "x" * 300_000),
        (10, "u", "WARC/1." * 3000), (None, "u", "no id"), (None, "u", "no id"), (None, "u", "<p>same</p>"), (11, "u", "twice"), (11, "u", "twice"),
        (12, "u", FAKE.replace("12", "90000")), (13, "u", "\r\n\r\n"), (14, "u", "ends in WARC/1.0"), (15, "http://long/" + "x" * 200_000, "long url")] + [(100 + i, "u", f"page {i} " + "y" * (i * 37 % 900)) for i in range(60)]


@pytest.mark.parametrize("range_bytes", [1 << 20, 997, 64])
def test_round_trip(spark, range_bytes):
    got = round_trip(spark, ROWS, range_bytes)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == brute(ROWS)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response" and r["page_id"]}
    assert payloads[7] == ROWS[6][2].encode() and payloads[8] == ROWS[7][2].encode()


def test_small_payloads_are_no_revisits(spark):
    got = round_trip(spark, ROWS, min_bytes=8)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == brute(ROWS, 8)


def test_records_behind_a_damaged_one_are_not_returned(spark, tmp_path):
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\n"
    good = [head.format(i, 5) + "abcde\r\n\r\n" for i in range(3)]
    (tmp_path / "a.warc").write_text(good[0] + good[1] + "damage" + good[2], newline="")
    (tmp_path / "b.warc").write_text("".join(good), newline="")
    (tmp_path / "c.warc").write_text("")
    got = W.read(spark, str(tmp_path), 64).collect()
    assert sorted(r["page_id"] for r in got) == [0, 0, 1, 1, 2]
    assert {r["payload_digest"] for r in got} == {digest("abcde")}


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_headers_of_any_length(spark, tmp_path):
    """Record and HTTP headers beyond every read; a magic whose lines are no
    header lines is none."""
    http = "HTTP/1.1 200 OK\r\n" + "".join(f"X-{i}: {'h' * 900}\r\n" for i in range(200)) + "\r\n"
    fake = "WARC/1.0\r\nWARC-Type: response\r\n" + "no header line\r\n" * 9000 + "Content-Length: 3\r\n\r\nabc\r\n\r\n"
    out = ""
    for i, body in enumerate(["first", fake, "x" * 100_000, "last"]):
        block = http + body
        out += (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Target-URI: http://a/{'u' * (i * 150_000)}\r\n"
                f"Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n")
    (tmp_path / "a.warc").write_text(out, newline="")
    for range_bytes in (1 << 23, 50_000):
        got = {r["page_id"]: r["payload_digest"] for r in W.read(spark, str(tmp_path), range_bytes).collect()}
        assert got == {0: digest("first"), 1: digest(fake), 2: digest("x" * 100_000), 3: digest("last")}


def test_long_urls_are_kept(spark):
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    W.write(pages_of(spark, [(1, "http://a/" + "u" * 200_000, "one"), (2, "http://b", "two")]), path)
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert "WARC-Target-URI: http://a/" + "u" * 200_000 + "\r\n" in text


def test_reach(spark, tmp_path):
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: {}\r\n\r\n"
    good = [head.format(i, 5) + "abcde\r\n\r\n" for i in range(3)]
    (tmp_path / "a.warc").write_text(good[0] + good[1] + "damage" + good[2], newline="")
    (tmp_path / "b.warc").write_text("".join(good), newline="")
    (tmp_path / "c.warc").write_text("nothing of the kind")
    got = {r["path"][-6:]: (r["records"], r["reached"], r["lost"]) for r in W.reach(spark, str(tmp_path), 64).collect()}
    n = len(good[0])
    assert got == {"a.warc": (2, 2 * n, n + 6), "b.warc": (3, 3 * n, 0), "c.warc": (0, 0, 19)}
