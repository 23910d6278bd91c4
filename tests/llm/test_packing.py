import random
import zlib

import numpy as np
import pyarrow as pa

from quarry.llm import packing as P
from quarry.llm.queries import tokenizer_path

ODD = ["", " ", "<|endoftext|> x<|startoftext|>y", "it's we'll I'M don't", "e\u0301 \u0301a A\u030a", "tab\there\r\nline\x0bvt\x0cff", "a\u00a0b\u2003c\x85d\x1ce",
       "ΑΣ ΣΑΣ. İI", "12345 3.14", "日本語のテキスト 中文", "\U0001F600\U0001F601 🏳️‍🌈", "!!! ??? ...", "Ünïcödé ÉÉÉ", "x" * 5000, " \u0301 start", "a \u0338= b"]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(encode, texts):
    ids, ends = encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


def test_encoder_equals_the_tokenizer(spark):
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    encode = P.Encoder(tokenizer_path())
    assert ids_of(encode, texts) == want
    assert ids_of(encode, texts) == want  # all from the cache


def test_encoder_with_a_small_cache(spark, monkeypatch):
    monkeypatch.setattr(P, "CACHE", 20)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    encode = P.Encoder(tokenizer_path())
    got = [x for at in range(0, len(texts), 7) for x in ids_of(encode, texts[at:at + 7])]
    assert got == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


def test_plain_chunks_of_every_letter_and_sign():
    letters = [chr(c) for c in range(0x21, 0x250)]
    chunks = [a + b for a in letters[::3] for b in letters[::7]] + [f"Wörd{x}" for x in letters] + [f"Wort{a}{b}" for a in letters[:94] for b in letters[:94]]
    text = [" ".join(chunks)]
    assert ids_of(P.Encoder(tokenizer_path()), text)[0] == tokenizer().encode(text[0], add_special_tokens=False).ids


def test_pieces_cover_every_document(spark, docs_of, awkward):
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)]
    window = 64
    got = P.pack(P.pieces(docs_of(rows), tokenizer_path(), window, 1, with_ids=True), window, shard_pieces=100).collect()
    tok = tokenizer()
    want = sorted((d if d is not None else -1, tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])) for d, t, *_ in rows)
    docs = {}
    for r in sorted(got, key=lambda r: (r["k1"], r["k2"], r["start"])):
        docs.setdefault((r["doc_id"] if r["doc_id"] is not None else -1, r["k1"], r["k2"]), []).append(r)
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    rebuilt = []
    for (d, *_), rs in docs.items():
        n = sum(r["start"] == 0 for r in rs)  # equal rows
        rebuilt += [(d, tuple(x for r in rs[::n] for x in r["ids"]))] * n
        assert {r["doc_tokens"] for r in rs} == {len(rebuilt[-1][1])}
    assert sorted(rebuilt) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for xs in by.values():
        at = 0
        for o, n in sorted(xs):
            assert o == at
            at += n
        assert at <= window


def brute_best_fit(lengths, window):
    rooms, out = [], []
    for x in lengths:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= x]
        if fits:
            r = min(fits)[0]
            i = max(i for q, i in fits if q == r)
        else:
            rooms.append(window)
            i = len(rooms) - 1
        out.append((window - rooms[i], rooms[i]))
        rooms[i] -= x
    return len(rooms), out


def test_best_fit_takes_the_tightest_window():
    rnd = random.Random(5)
    for _ in range(50):
        window = rnd.choice([8, 10, 64, 100])
        lengths = sorted((rnd.randint(1, window) for _ in range(rnd.randint(0, 80))), reverse=True)
        sequences, offsets = P.best_fit(lengths, window)
        n, places = brute_best_fit(lengths, window)
        assert len(set(sequences)) == n and offsets == [o for o, _ in places]


def test_little_padding():
    rnd = random.Random(6)
    lengths = sorted((min(2047, int(rnd.lognormvariate(6, 1)) + 1) for _ in range(20000)), reverse=True)
    sequences, _ = P.best_fit(lengths, 2048)
    assert sum(lengths) / (2048 * len(set(sequences))) > 0.99


def test_empty_table(docs_of):
    assert P.pack(P.pieces(docs_of([]), tokenizer_path())).count() == 0
