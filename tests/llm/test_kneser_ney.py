import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import kneser_ney as K

TRAIN = ["the cat sat on the mat and the dog sat on the cat", "a dog and a cat and a bird sat there", "the bird sang to the dog on the mat \U0001F600",
         "and then the cat and the dog went to the other mat"] * 2 + ["one more text"]


def brute_model(texts):
    """p(gram) of interpolated modified Kneser-Ney over UTF-16 units."""
    def units(t):
        b = ("\n\n\n" + t).encode("utf-16-le")
        return [int.from_bytes(b[i:i + 2], "little") for i in range(0, len(b), 2)]

    c = {4: Counter(tuple(u[i:i + 4]) for u in map(units, texts) for i in range(len(u) - 3))}
    for k in (3, 2, 1):
        c[k] = Counter(g[1:] for g in c[k + 1])
    disc, ctx = {}, {}
    for k in c:
        n = Counter(min(x, 5) for x in c[k].values())
        if min(n[1], n[2], n[3]) > 0:
            y = n[1] / (n[1] + 2 * n[2])
            n4 = sum(1 for x in c[k].values() if x == 4)
            raw = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n4 / n[3])
        else:
            raw = (0.5, 1.0, 1.5)
        disc[k] = [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]
        ctx[k] = defaultdict(lambda: [0, 0.0])
        for g, a in c[k].items():
            ctx[k][g[:-1]][0] += a
            ctx[k][g[:-1]][1] += disc[k][min(a, 3) - 1]

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / 65536
        if g[:-1] not in ctx[k]:
            return low
        total, saved = ctx[k][g[:-1]]
        a = c[k].get(g, 0)
        return ((a - disc[k][min(a, 3) - 1]) / total if a else 0) + saved / total * low

    def ppl(t):
        u = units(t)
        grams = [tuple(u[i:i + 4]) for i in range(len(u) - 3)]
        return math.exp(-sum(math.log(p(g)) for g in grams) / len(grams))

    return p, ppl


def test_probabilities_sum_to_one():
    p, _ = brute_model(TRAIN)
    for context in ((ord("t"), ord("h"), ord("e")), (1, 2, 3)):
        assert sum(p((*context, u)) for u in range(65536)) == pytest.approx(1)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 16 * 30])
def test_perplexity_matches_brute_force(docs_of, spark, broadcast_bytes):
    texts = TRAIN + ["Something ELSE!! ### zzz", "the cat", "x", "\U0001F601 new", "", None, "the cat"]
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(texts)]
    docs = docs_of(rows + [(999, "no model", "de"), (998, "no language", None), (0, TRAIN[0], "fr"), (None, "an id is missing", "en")])
    labels = spark.createDataFrame([(i, 1, 0, "clash") for i in range(len(TRAIN))] * 2 + [(len(TRAIN), 1, 1, ""), (len(TRAIN) + 1, 0, 0, ""), (None, 1, 0, ""), (5000, 1, None, "")],
                                   "doc_id long, quality int, toxic int, lang string")
    held = {r["id"] for r in spark.range(len(TRAIN)).where(F.pmod(F.xxhash64(F.lit("held"), "id"), F.lit(K.HELD_OUT)) == 0).collect()}
    got = K.classify(docs, labels, broadcast_bytes=broadcast_bytes).collect()
    assert len(got) == len(rows) + 4
    for lang in ("en", "fr"):
        train = [t for i, t, g in rows if i < len(TRAIN) and i not in held and g == lang]
        train += [TRAIN[0]] if lang == "fr" and 0 not in held else []
        _, ppl = brute_model(train)
        for r in got:
            if r["lang"] == lang:
                text = "an id is missing" if r["doc_id"] is None else texts[r["doc_id"]]
                if text:
                    assert r["perplexity"] == pytest.approx(ppl(text), rel=1e-4)
                else:
                    assert r["perplexity"] is None and not r["kept"]
    by = {r["doc_id"]: r for r in got}
    assert by[999]["kept"] and by[999]["perplexity"] is None and by[998]["kept"] and by[998]["lang"] is None


def test_rejects_noise_and_keeps_clean_text(spark, docs_of):
    import random

    rnd = random.Random(2)
    parts = ["an", "the", "ing", "ou", "re", "st", "tion", "er"]
    sentence = lambda: " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(60))
    rows = [(i, sentence()) for i in range(300)] + [(1000 + i, sentence()) for i in range(100)]
    rows += [(2000 + i, " ".join(w.upper() + "!!" for w in sentence().split())) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in K.classify(docs_of(rows), labels).collect()}
    assert sum(got[1000 + i] for i in range(100)) >= 99 and not any(got[2000 + i] for i in range(20))


def test_parts_cover_every_language():
    parts = K._parts({"a": 5, "b": 5, "c": 25, "d": 1}, 10)
    assert sum(x[0] == ["c"] for x in parts) == 3 and {y for x in parts for y in x[0]} == set("abcd")


def test_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert K.classify(docs_of([]), labels).count() == 0
    got = K.classify(docs_of([(1, "a"), (2, "")]), labels).collect()
    assert {r["doc_id"]: r["kept"] for r in got} == {1: True, 2: False}


def prose(rnd, n=60):
    parts = ["an", "the", "ing", "ou", "re", "st", "tion", "er"]
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_rejects_repeated_words(spark, docs_of):
    import random

    rnd = random.Random(3)
    rows = [(i, prose(rnd)) for i in range(300)] + [(1000 + i, prose(rnd)) for i in range(100)]
    rows += [(2000 + i, f"{w} " * 60) for i, w in enumerate(("the", "other", "string", "ou", "restan"))]
    rows += [(2100, "the " * 40 + "string " * 40 + "an " * 40), (2101, prose(rnd, 5) + " string" * 80)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in K.classify(docs_of(rows), labels).collect()}
    assert not any(v for k, v in got.items() if k >= 2000) and sum(got[1000 + i] for i in range(100)) >= 99


def test_language_with_few_trusted_documents_is_filtered(spark, docs_of):
    import random

    rnd = random.Random(4)
    rows = [(i, prose(rnd)) for i in range(200)] + [(1000 + i, prose(rnd), "fr") for i in range(6)]
    rows += [(2000 + i, prose(rnd), "fr") for i in range(30)]
    rows += [(3000 + i, " ".join(w.upper() + "!!" for w in prose(rnd).split()), "fr") for i in range(10)] + [(4000, "the " * 60, "fr"), (4001, "the " * 60, "xx")]
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows[:206]], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in K.classify(docs_of(rows), labels).collect()}
    assert got[2000]["threshold"] is not None and not any(r["kept"] for k, r in got.items() if k >= 3000)
    assert sum(got[2000 + i]["kept"] for i in range(30)) >= 29


def test_trusted_documents_are_scored_without_their_fold(docs_of, spark):
    """With no margin the threshold is the largest of these scores."""
    texts = TRAIN * 3
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    fold = {r["id"]: r["f"] for r in spark.range(len(texts)).select("id", F.pmod(F.xxhash64(F.lit("held"), "id"), F.lit(K.HELD_OUT)).alias("f")).collect()}
    want = max(brute_model([x for j, x in enumerate(texts) if fold[j] != fold[i]])[1](t) for i, t in enumerate(texts))
    got = K.classify(docs_of(list(enumerate(texts))), labels, quantile=1.0, margin=1.0).collect()
    assert all(r["threshold"] == pytest.approx(want, rel=1e-4) for r in got)


def test_distinct_shares():
    import numpy as np

    texts = ["", None, "x" * (K.WINDOW - 1), "x" * 100, "abcdefghij" * 20, "\U0001F600" * 30, "".join(map(chr, range(200, 400)))]
    for t, s in zip(texts, K.distinct_shares(texts), strict=True):
        u = np.frombuffer((t or "").encode("utf-16-le"), "<u2").tolist()
        grams = [tuple(u[i:i + K.WINDOW]) for i in range(len(u) - K.WINDOW + 1)]
        assert s == len(set(grams)) / len(grams) if grams else math.isnan(s)
