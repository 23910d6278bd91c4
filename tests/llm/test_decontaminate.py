import random
from itertools import combinations

from quarry.llm import decontaminate as D

RND = random.Random(3)
VOCAB = [f"w{i}" for i in range(5000)]


def words(n):
    return [RND.choice(VOCAB) for _ in range(n)]


def test_masks_meet_every_pair_of_substitutions():
    for bad in combinations(range(D.WINDOW), D.SUBSTITUTIONS):
        assert any(not {at + p for p in m} & set(bad) for m in D.MASKS for at in range(D.WINDOW - m[-1]))


def brute(doc, item):
    """Whether any aligned window passes."""
    need = min(D.WINDOW, len(item))
    allowed = D.SUBSTITUTIONS if len(item) >= D.WINDOW else 1
    if len(item) < D.MIN_WORDS:
        return False
    return any(sum(a != b for a, b in zip(doc[i:i + need], item[j:j + need])) <= allowed
               for j in range(len(item) - need + 1) for i in range(len(doc) - need + 1))


def test_matches_brute_force(spark, docs_of, awkward):
    items = {1: words(40), 2: words(13), 3: words(9), 4: words(5), 5: words(3), 6: words(25)}
    items[7] = list(items[6])
    docs = {}
    for i in range(60):
        w, k = words(60), 1 + i % 6
        part = list(items[k])
        for at in RND.sample(range(len(part)), min(i % 4, len(part))):
            part[at] = "changed"
        cut = part if i % 5 else part[: 3 + 2 * len(part) // 3]
        docs[100 + i] = w[:30] + cut + w[30:]
    docs |= {200 + i: words(80) for i in range(10)}
    rows = awkward + [(d, " ".join(w).title() + ("." if d % 2 else "")) for d, w in docs.items()]
    bench = spark.createDataFrame([(i, " ".join(w) + "!", "x") for i, w in items.items()] + [(8, None, ""), (9, "", ""), (None, " ".join(items[2]), "")],
                                  "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]) for r in D.matches(docs_of(rows), bench).collect()}
    want = {(d, i) for d, w in docs.items() for i, x in items.items() if brute(w, x)}
    want |= {(d, None) for d, w in docs.items() if brute(w, items[2])}
    assert got == want and any(d for d, _ in want)
    small = D.matches(docs_of(rows), bench, chunk_bytes=2000)  # several passes
    assert {(r["doc_id"], r["item_id"]) for r in small.collect()} == want
    kept = D.clean(docs_of(rows), bench)
    assert kept.count() == len(rows) - len({d for d, _ in want})
    assert "x-k1" == kept.first()["k1"]


def test_span_of_the_overlap(spark, docs_of):
    item = words(20)
    doc = words(10) + item + words(10)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    r = D.matches(docs_of([(1, " ".join(doc))]), bench).first()
    assert (r["start_word"], r["end_word"], r["n_equal"], r["item_words"]) == (10, 30, 20, 20)


def test_passage_across_parts_of_a_long_text(spark, docs_of, monkeypatch):
    monkeypatch.setattr(D, "BATCH_WORDS", 50)
    item = words(20)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = [(i, " ".join(words(35 + i) + item + words(40))) for i in range(30)]
    assert D.matches(docs_of(docs), bench).count() == 30


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.matches(docs_of([]), bench).count() == 0
    none = bench.where("false")
    assert D.matches(docs_of([(1, "a b c d e f")]), none).count() == 0
    assert D.clean(docs_of([(1, "a b c d e f"), (2, None)]), none).count() == 2


def test_short_items_must_occur_whole_and_unchanged(spark, docs_of):
    bench = spark.createDataFrame([(1, "red green blue black"), (2, "zebra"), (3, "red green"), (4, "")], "item_id long, text string")
    docs = docs_of([(1, "a Red, green; blue black b"), (2, "red green blue white"), (3, "one zebra two zebra"), (4, "green red"), (5, None), (6, "zebras")])
    assert D.matches(docs, bench).count() == 0
    got = {(r["doc_id"], r["item_id"], r["start_word"], r["end_word"]) for r in D.matches(docs, bench, min_words=1).collect()}
    assert {g[:2] for g in got} == {(1, 1), (1, 3), (2, 3), (3, 2)} and (1, 1, 1, 5) in got and (2, 3, 0, 2) in got


def test_equal_items_are_searched_once(spark, docs_of):
    item = " ".join(words(20))
    bench = spark.createDataFrame([(i, item) for i in range(30)] + [(None, item)], "item_id long, text string")
    docs = docs_of([(i, f"before {item} behind") for i in range(20)])
    once = D.matches(docs, bench, expand=False).collect()
    assert len(once) == 20 and {(r["item_id"], r["n_items"]) for r in once} == {(0, 31)}
    assert D.matches(docs, bench).count() == 20 * 31
