import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from quarry.llm import divergence as D

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, min_docs=3, top=200):
    docs = [(lang or "", source or "", brute_terms(text)) for lang, source, text in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for *_, ts in own for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = {s: Counter() for _, s, _ in own}
        for _, s, ts in own:
            counts[s].update(t for t in ts if df[t] >= min_docs)
        whole = sum(counts.values(), Counter())

        def shares(c):
            d = sum(c.values()) + len(kept)
            return {t: 1 + 1000000000 * (c[t] + 1) // d for t in kept}

        f = lambda p, q: (p - q) * (p - q) // q
        ps, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(f(ps[s][t], q[t]), t) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(rows, 1) if part == "pair" or r <= top]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdeéß日") for _ in range(rnd.randint(1, 3))) for _ in range(150)]
    docs = []
    for _ in range(300):
        lang, source = rnd.choice(["en", "en", "en", "de", "x/y: é"]), f"s{min(rnd.randint(0, 9), rnd.randint(0, 9))}"
        docs.append((lang, source, "".join(rnd.choice(vocab).title() + rnd.choice(" ,.0\n") for _ in range(rnd.randint(0, 40)))))
    return docs + [("en", "only", "seldom words once"), ("en", "none", None), ("de", "none", "123"), (None, None, "a a b"), (None, "s", "c"),
                   ("EN", "s", "few")] + docs[:20]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, lang, s, "x", "y") for i, (lang, s, t) in enumerate(docs)],
                                 "doc_id long, text string, lang string, source string, shard string, part string")


@pytest.mark.parametrize("shard_terms,cell", [(D.SHARD_TERMS, D.CELL), (40, 3)])
def test_equals_brute_force(spark, texts, shard_terms, cell):
    got = rows(D.audit(frame(spark, texts).repartition(4), shard_terms=shard_terms, cell=cell))
    assert got == brute(texts)


def test_few_top_terms(spark, texts):
    assert rows(D.audit(frame(spark, texts), top_terms=2)) == brute(texts, top=2)


def test_awkward_rows(spark, docs_of, awkward):
    df = docs_of(awkward)
    assert rows(D.audit(df)) == brute([(r["lang"], r["source"], r["text"]) for r in df.collect()])
    assert rows(D.audit(docs_of([]))) == []
    assert rows(D.audit(docs_of([(1, None), (2, "", "en", "s1")]))) == brute([("en", "s0", None), ("en", "s1", "")])


def test_terms_of_arrow_slices(awkward):
    texts = [r[1] for r in awkward] + ["A-b\tÉé9z", "日本 語"]
    arr = pa.array(texts).slice(1)
    at, terms = D._terms(arr)
    assert list(zip(at.tolist(), terms.to_pylist(), strict=True)) == [(i, t) for i, x in enumerate(texts[1:]) for t in brute_terms(x)]
