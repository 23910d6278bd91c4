import re
from collections import Counter

from quarry.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    c = Counter(grams)
    spots = {i + j for i, g in enumerate(grams) if c[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(spots))


def test_base_measures_match_brute_force(docs_of, awkward):
    rows = awkward + [(20, "a a a a a"), (21, "a b c a b c x y"), (22, "one\ntwo\none\n\n\ntwo\n one"), (23, "a b c d a b c d b c d e f"),
                      (24, "### $$ | <b> fine"), (25, "p q r p q r p q r p q")]
    got = Q.judge(docs_of(rows)).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r["text"])
        assert tuple(r)[2:7] == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_rules_judge_clean_and_junk(docs_of):
    clean = " ".join(f"the word{i} of item{i} and then more{i} to see{i}" for i in range(20))
    rows = [(1, clean), (2, " ".join(f"{w}***" for w in clean.split())), (3, " | ".join(clean.split())),
            (4, " ".join(w.upper() + "!!" for w in clean.split())), (5, "again and again " * 40), (6, "1 2 3 " * 40), (7, "short text")]
    got = {r["doc_id"]: r for r in Q.judge(docs_of(rows)).collect()}
    assert got[1]["kept"] and got[1]["failed"] == []
    assert not any(got[i]["kept"] for i in range(2, 8))
    assert "symbols" in got[2]["failed"] and "stop_words" in got[4]["failed"] and got[7]["base_failed"]


def test_one_projection_without_shuffle_or_python(spark, docs_of):
    plan = Q.judge(docs_of([(1, "a b")], extra=False))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Pandas|Arrow", plan)


def test_empty_table(docs_of):
    assert Q.judge(docs_of([])).count() == 0
