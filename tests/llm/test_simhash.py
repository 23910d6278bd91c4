import random

import pytest
import xxhash

from quarry.llm import simhash as S
from quarry.llm.components import connected_components


def brute_fp(text):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
    ws = [w for w in ws.replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, max_bits):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ns = sorted(nodes)
    for i, a in enumerate(ns):
        for b in ns[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    return {x: find(x) for x in ns}


def test_fingerprint(awkward):
    for _, t, *_ in awkward + [(0, "One two"), (0, "A B C D a b c d"), (0, "word")]:
        if t is None or len(t) < 10_000:
            assert S.fingerprint(t) == brute_fp(t)


def test_hash_equals_sparks(spark):
    assert spark.sql("SELECT xxhash64('Ab c ü') AS h").first()["h"] & (1 << 64) - 1 == xxhash.xxh64_intdigest("Ab c ü".encode(), 42)


def test_blocks_meet_every_close_pair():
    masks, rnd = S.block_masks(), random.Random(1)
    assert len(masks) == 20 and sum(S.BLOCK_BITS) == 64
    for _ in range(2000):
        diff = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("max_bucket", [16384, 40, 3])
def test_links_join_what_brute_force_joins(spark, max_bucket):
    rnd = random.Random(7)
    nodes = {rnd.getrandbits(64) for _ in range(40)}
    for center in list(nodes)[:4]:  # chains
        for _ in range(20):
            center ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))
            nodes.add(center)
    ball = rnd.getrandbits(64)  # a dense group
    nodes |= {ball ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5))) for _ in range(150)}
    low = rnd.getrandbits(32) << 32  # one half in common and nothing else
    nodes |= {low | rnd.getrandbits(32) for _ in range(150)}
    df = spark.createDataFrame([(S._signed(x),) for x in nodes], "fp long")
    links = S.link_fingerprints(df, 3, max_bucket)
    pairs = links.collect()
    assert all(((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= 3 for r in pairs)
    root = {r["u"]: r["v"] for r in connected_components(links).collect()}
    want = brute_components(nodes, 3)
    groups = {}
    for x in nodes:
        groups.setdefault(root.get(S._signed(x), S._signed(x)), set()).add(want[x])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_components_of_documents(docs_of, awkward):
    base = "the quick brown fox jumps over the lazy dog and runs on through many other fields of the land " * 3
    rows = awkward + [(30, base), (31, base.upper()), (32, base.replace(" ", "\n")), (40, base + "tail"), (None, base)]
    got = S.components(docs_of(rows)).collect()
    assert len(got) == len(rows)
    fps = sorted(((d, brute_fp(t) if t is None or len(t) < 10_000 else S.fingerprint(t)) for d, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in got), key=repr) == fps
    comp = brute_components({f for _, f in fps}, 3)
    least = {}
    for d, f in fps:
        if d is not None:
            least[comp[f]] = min(least.get(comp[f], d), d)
    for r in got:
        assert r["component_id"] == least.get(comp[r["fp"] & (1 << 64) - 1])


def test_keep_one(docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text), (3, text), (None, text), (9, "another text altogether here"), (None, "a lonely text with no id"), (7, None), (8, "")]
    kept = S.keep_one(docs_of(rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(
        [(3, text), (9, rows[4][1]), (None, rows[5][1]), (7, None)], key=repr)
    assert kept[0]["fp"] == "x-fp"


def test_empty_table(docs_of):
    assert S.components(docs_of([])).count() == 0 and S.keep_one(docs_of([])).count() == 0


def test_connected_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    got = {(r["u"], r["v"]) for r in connected_components(edges).collect()}
    assert got == {(i, 0) for i in range(1, 201)} | {(501, 500)}
