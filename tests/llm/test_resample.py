import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import resample as R

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_buckets(text):
    ws = brute_words(text)
    return [zlib.crc32(" ".join(ws[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def brute(docs, target, percent=5, min_words=20):
    s = Counter(b for _, t in docs for b in brute_buckets(t))
    t = Counter(b for x in target for b in brute_buckets(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out, able = [], []
    for i, (d, text) in enumerate(docs):
        bs = brute_buckets(text)
        w = sum(gain[b] for b in bs)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        sc = w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(bs), w, sc, None])
        if len(brute_words(text)) >= min_words:
            able.append((-sc, d is None, d or 0, i))
    for r, (*_, i) in enumerate(sorted(able)[:percent * len(able) // 100], 1):
        out[i][4] = r
    return sorted((tuple(r) for r in out), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.fixture(scope="module")
def items():
    rnd = random.Random(3)
    vocab = ["alpha", "Beta", "gamma9", "délta", "ÉPSILON", "x", "the", "of", "日本語"]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "_", "\x7f"]) for _ in range(n))
    docs = [(i, text(rnd.choice([0, 3, 19, 20, 21, 60]))) for i in range(400)]
    return docs + docs[:30], [text(30) for _ in range(20)] + [None, ""]


def test_equals_brute_force(spark, docs_of, items):
    docs, target = items
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert rows(R.resample(docs_of(docs).repartition(5), bench)) == brute(docs, target)
    assert rows(R.resample(docs_of(docs), bench, percent=100, min_words=0)) == brute(docs, target, 100, 0)


def test_awkward_rows(spark, docs_of, awkward):
    bench = spark.createDataFrame([(1, "a text without an id")], "item_id long, text string")
    docs = [r[:2] for r in awkward]
    assert rows(R.resample(docs_of(awkward), bench, percent=50, min_words=1)) == brute(docs, ["a text without an id"], 50, 1)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(R.resample(docs_of([]), none)) == []
    docs = [(i, "one two three " * 9) for i in range(40)]
    assert rows(R.resample(docs_of(docs), none)) == brute(docs, [])


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1 << 20])
def test_pieces_hold_the_same_features(size, awkward, items):
    for text in [r[1] for r in awkward if r[1] is None or len(r[1]) < 1000] + [t for _, t in items[0][:60]]:
        got = list(R.features((text or "").encode(), size))
        assert sum(n for n, _ in got) == len(brute_words(text))
        assert Counter(b for _, bs in got for b in bs.tolist()) == Counter(brute_buckets(text))


@pytest.mark.parametrize("pivots", [1, 4, 15])
def test_kth_key(spark, pivots):
    rnd = random.Random(5)
    keys = [(rnd.randint(-3, 3), rnd.randint(0, 2), i) for i in range(300)]
    df = spark.createDataFrame(keys, "a long, b long, c long").repartition(4).cache()
    for k in (1, 2, 150, 299, 300):
        assert tuple(R.kth_key(df, ["a", "b", "c"], k, pivots)) == sorted(keys)[k - 1]
    assert R.kth_key(df, ["a", "b", "c"], 301, pivots) is None
    assert R.kth_key(df.where("a > 9"), ["a", "b", "c"], 1, pivots) is None


def test_ranks_follow_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"))
    got = sorted((r["v"], r["rank"]) for r in R.ranked(df, ["v"]).collect())
    assert [r for _, r in got] == list(range(1, 1001))
