import re

from quarry.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(text):
    ws = WORD.findall(lower(text))
    places, base = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base))


TEXTS = ["Licensed under CC BY-NC 4.0.", "cc by cc by; CC-BY", "All rights reserved. all RIGHTS reserved", "the General Public License", "general public\nlicense",
         "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "É all rights reservedÉ", "İ K all",
         "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version", "mit was here", "cc", "all rights", "\x1cALL\x1frights\x7freserved"]


def test_base_columns_match_brute_force(docs_of, awkward):
    rows = awkward + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, f"{a} {b}") for i, (a, b) in enumerate(zip(TEXTS, TEXTS[1:], strict=False))]
    got = L.scan(docs_of(rows)).collect()
    want = sorted(((d, *brute(t)) for d, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=repr) == want
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert r["labels"].split(",") == sorted(set(r["labels"].split(",")))


def test_template_labels(docs_of):
    rows = list(enumerate(TEXTS)) + [(50, "some words before " + TEXTS[9] + " and behind"), (51, "licence of apache under no version 3 0"), (52, None)]
    got = {r["doc_id"]: r for r in L.scan(docs_of(rows)).collect()}
    assert got[0]["labels"] == "cc-by,cc-by-nc-4.0" and got[0]["score"] == 1
    assert got[5]["labels"] == "mit" and got[6]["labels"] == "gpl,gpl-3.0" and got[9]["labels"] == "apache-2.0" and got[50]["labels"] == "apache-2.0"
    assert got[10]["labels"] == "" and got[11]["labels"] == "" and got[51]["labels"] == "" and (got[52]["labels"], got[52]["score"]) == ("", 0)
    assert got[2]["labels"] == "reserved"


def test_changed_word_lowers_the_score_but_a_missing_phrase_rejects(docs_of):
    notice = "Permission is hereby granted, free of charge, to any individual obtaining a copy of this software"
    got = {r["doc_id"]: r for r in L.scan(docs_of([(1, notice), (2, notice.replace("free of charge", "at no cost at"))])).collect()}
    assert got[1]["labels"] == "mit" and 0.9 < got[1]["score"] < 1 and got[2]["labels"] == ""


def test_rarest_words_are_looked_up():
    idf = {w: 0.1 for t in L.TEMPLATES for w in L._phrase(t.text)} | {b"apache": 9.0, b"version": 5.0}
    index = L.Index(L.TEMPLATES, idf)
    assert (0, 3) in index.postings[b"apache"] and len({w for w, ps in index.postings.items() if any(k == 0 for k, _ in ps)}) == L.RARE_WORDS


def test_empty_table(docs_of):
    assert L.scan(docs_of([])).count() == 0


def test_text_that_begins_inside_a_template(docs_of):
    rows = [(1, "MIT License\n\nCopyright (c) someone"), (2, "Apache License\nVersion 2.0, January 2004"), (3, "GNU General Public License version 3, 29 June 2007"),
            (4, "GNU Lesser General Public License"), (5, "free of charge, to any person obtaining a copy of this software"), (6, "license mit")]
    got = {r["doc_id"]: r for r in L.scan(docs_of(rows)).collect()}
    assert [got[i]["labels"] for i in range(1, 7)] == ["mit", "apache-2.0", "gpl,gpl-3.0", "gpl,lgpl", "", ""]
    assert got[1]["score"] == 2 / 5 and got[2]["score"] == 5 / 8 and got[3]["score"] == 6 / 12


NAMES = {"CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0", "BSD 3-Clause License": "bsd", "ISC License": "isc", "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
         "SPDX-License-Identifier: BSD-3-Clause": "bsd", "distributed under the ISC license": "isc", "available under the MIT License": "mit",
         "Creative Commons Attribution-ShareAlike 3.0 International License": "cc-by-sa-3.0", "licensed under the GNU Affero General Public License": "agpl",
         "This is free and unencumbered software released into the public domain": "unlicense"}


def test_names_alone_and_inside_a_text(docs_of):
    names = list(NAMES)
    rows = list(enumerate(names)) + [(100 + i, f"one two three four five {n} six seven eight nine") for i, n in enumerate(names)]
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in L.scan(docs_of(rows)).collect()}
    for i, n in enumerate(names):
        assert NAMES[n] in got[i], n
        assert n == "ISC License" or NAMES[n] in got[100 + i], n  # two words of running text name no licence


def test_running_text_is_no_notice(docs_of):
    rows = [(1, "many people like the mit license for its short text"), (2, "he asked which isc license they meant"), (3, "permission is hereby granted to enter the garden free of charge"),
            (4, "a version 3 of the public house"), (5, "redistribution of wealth and use in source and binary forms")]
    assert {r["labels"] for r in L.scan(docs_of(rows)).collect()} == {""}


def test_labels_and_score_match_brute_force(docs_of):
    """Every template at every shift, without an index."""
    import math
    import random
    rnd, rows = random.Random(8), []
    filler = ["the", "software", "license", "under", "of", "a", "public", "version", "2", "0", "3", "cc", "by", "river", "stone"]
    for i in range(250):
        t = rnd.choice(L.TEMPLATES).text.split()
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            t[rnd.randrange(len(t))] = rnd.choice(filler)
        a, b = rnd.choice([(0, len(t)), (0, len(t)), (2, len(t)), (0, len(t) - 2)])
        more = rnd.choice(L.TEMPLATES).text.split() if i % 3 == 0 else []
        rows.append((i, " ".join([*rnd.choices(filler, k=rnd.choice([0, 3, 40])), *t[a:b], *rnd.choices(filler, k=rnd.choice([0, 5])), *more])))
    n = {}
    for _, t in rows:
        for w in set(L.scan_words(t)):
            n[w] = n.get(w, 0) + 1
    idf = lambda w: math.log((1 + len(rows)) / (1 + n.get(w, 0)))
    want = {}
    for d, t in rows:
        ws, labels, score = L.scan_words(t), set(filter(None, brute(t)[4].split(","))), 0.0
        for x in L.TEMPLATES:
            xs = x.text.encode().split()
            rare = sorted(set(xs) & set(ws), key=lambda w: (-idf(w), w))[:8]
            for shift in range(1 - len(xs), len(ws)):
                pairs = [(ws[shift + p], w) for p, w in enumerate(xs) if 0 <= shift + p < len(ws)]
                same = [w for v, w in pairs if v == w]
                here = b" " + b" ".join(v for v, _ in pairs) + b" "
                if len(set(same) & set(rare)) >= 2 and len(same) >= x.least * len(pairs) and all(b" %b " % p.encode() in here for p in x.phrases):
                    labels.add(x.label)
                    score = max(score, len(same) / len(xs))
        want[d] = (",".join(sorted(labels)), score)
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in L.scan(docs_of(rows)).collect()} == want
    assert len({w for w, _ in want.values()}) > 20
