"""License scan by a positional index of rare template words.

The index holds the postings (template, place) of every template word. Document
frequencies of these words over the whole corpus give each word's IDF. A
file's licence words are looked up from the highest IDF down: each posting
proposes a template at one relative position (place in the file minus place in
the template), until a template has had ``RARE_WORDS`` words of the file. Only
templates all of whose mandatory words are in the file are looked for.
Positions on which ``MIN_AGREE`` words agree are candidates. A candidate counts
if all mandatory phrases of the template stand there consecutively and at least
``least`` of the words that fall inside the file are in place; its score is the
share of all the template's words found in place. A file may begin or end
inside a template; the words that it lacks lower the score alone.

The index is as large as the templates, whatever the corpus. The scan reads
the texts twice (frequencies, then matches) and shuffles one count per template
word and task.

Defined cases: null and empty texts have no words, no label and score 0.
Repeated rows are scanned alike. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """``text``: the words of a notice or of a passage of a licence; ``phrases``
    must all occur where it is placed, and at least ``least`` of its words that
    fall inside the file must be in place."""

    label: str
    text: str
    phrases: tuple[str, ...]
    least: float = 0.65


# The wording of common licence notices.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0"), 0.6),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3"), 0.5),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2"), 0.5),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",), 0.5),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",), 0.5),
    Template("bsd", "bsd 2 clause license", ("bsd 2 clause license",)),
    Template("bsd", "bsd 3 clause license", ("bsd 3 clause license",)),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
)

# Licences named by "... under the <name>", and how such a notice begins.
NAMED = (("mit", "mit license"), ("isc", "isc license"), ("zlib", "zlib license"), ("unlicense", "unlicense"), ("bsd", "bsd license"),
         ("boost-1.0", "boost software license version 1 0"), ("mpl-2.0", "mozilla public license version 2 0"),
         ("epl-2.0", "eclipse public license version 2 0"))
LEADS = ("released under the", "licensed under the", "distributed under the", "available under the", "under the terms of the")

# The passages of licence texts that tell a licence from others, with their key phrases.
PASSAGES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
             "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
             "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
             ("permission is hereby granted", "free of charge", "deal in the software without restriction")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
             "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
             ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
             "copyright notice and this permission notice appear in all copies", ("permission to use copy modify", "for any purpose with or without fee is hereby granted")),
    Template("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely "
             "subject to the following restrictions", ("permission is granted to anyone to use this software", "alter it and redistribute it freely")),
    Template("boost-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation "
             "covered by this license", ("permission is hereby granted", "any person or organization", "covered by this license")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("cc0-1.0", "has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
             ("except in compliance with the license", "apache org licenses license 2 0")),
    Template("gpl-3.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either "
             "version 3 of the license or at your option any later version", ("gnu general public license as published by the free software foundation", "version 3 of the license")),
    Template("gpl-2.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either "
             "version 2 of the license or at your option any later version", ("gnu general public license as published by the free software foundation", "version 2 of the license")),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
             ("gnu lesser general public license as published by",)),
    Template("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
             ("gnu affero general public license as published by",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
)

# Identifiers behind "SPDX-License-Identifier:", with their labels.
SPDX = {"apache-2.0": "apache-2.0", "mit": "mit", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd",
        "bsl-1.0": "boost-1.0", "mpl-2.0": "mpl-2.0", "epl-2.0": "epl-2.0", "gpl-2.0": "gpl-2.0", "gpl-3.0": "gpl-3.0", "lgpl-2.1": "lgpl", "lgpl-3.0": "lgpl",
        "agpl-3.0": "agpl", "cc0-1.0": "cc0-1.0"}

# The terms of Creative Commons licences, short and long, and their versions.
CC_TERMS = {"by": "attribution", "by nc": "attribution noncommercial", "by sa": "attribution sharealike", "by nd": "attribution noderivatives",
            "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives"}
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")


def _templates() -> tuple[Template, ...]:
    """The notices, passages and those that follow from the tables above."""
    out = [*NOTICES, *PASSAGES]
    out += [Template(label, f"{lead} {name}", (name,)) for label, name in NAMED for lead in LEADS]
    for name, label in SPDX.items():
        text = "spdx license identifier " + " ".join(_spelt(name))
        out.append(Template(label, text, (text,)))
    for terms, spelt in CC_TERMS.items():
        for version in CC_VERSIONS:
            label, number = f"cc-{terms.replace(' ', '-')}-{version}", version.replace(".", " ")
            out.append(Template(label, f"licensed under cc {terms} {number}", (f"cc {terms} {number}",)))
            out.append(Template(label, f"creative commons {spelt} {number} international license", (f"creative commons {spelt} {number}",)))
    return tuple(out)


RARE_WORDS = 8  # of a file, looked up for a template
MIN_AGREE = 2  # of them that must agree on a position

# A-Z to a-z; every other ASCII character that is no digit or letter separates
_TABLE = bytes(c if c >= 0x80 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))


def scan_words(text: str | None) -> list[bytes]:
    """Words of the lower-cased text: runs of ASCII digits and letters and of
    all characters beyond ASCII."""
    return (text or "").encode().translate(_TABLE).split()


def _spelt(text: str) -> list[str]:
    return [w.decode() for w in scan_words(text)]


TEMPLATES = _templates()


def _phrase(text: str) -> tuple[bytes, ...]:
    return tuple(text.encode().split())


def _stands(words: list[bytes], phrase: tuple[bytes, ...]) -> bool:
    return any(tuple(words[j:j + len(phrase)]) == phrase for j in range(len(words) - len(phrase) + 1))


class Index:
    """Templates, postings of their words, and the phrases."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]):
        self.templates = templates
        self.words = [_phrase(t.text) for t in templates]
        self.phrases = [[_phrase(p) for p in t.phrases] for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.words):
            for p, w in enumerate(words):
                self.postings.setdefault(w, []).append((k, p))
        self.agree = [min(MIN_AGREE, len(set(words))) for words in self.words]
        self.rank = {w: i for i, w in enumerate(sorted(self.postings, key=lambda w: (-idf.get(w, 0.0), w)))}
        # a template's mandatory words, filed under the rarest of them
        self.needs: dict[bytes, list[tuple[int, frozenset[bytes]]]] = {}
        for k, phrases in enumerate(self.phrases):
            need = frozenset(w for p in phrases for w in p)
            self.needs.setdefault(min(need, key=self.rank.__getitem__), []).append((k, need))
        self.base = {}
        for text, label in BASE.items():
            p = _phrase(text)
            self.base.setdefault(p[0], []).append((p, label))
        self.known = set(self.postings) | set(self.base)

    def candidates(self, at: dict[bytes, list[int]]) -> Iterator[tuple[int, int]]:
        """(template, shift) on which enough of the file's rarest licence words
        agree; ``at``: the places of each known word of the file."""
        present = at.keys()
        possible = {k for w in present & self.needs.keys() for k, need in self.needs[w] if need <= present}
        if not possible:
            return
        agree: dict[tuple[int, int], set[bytes]] = {}
        used: dict[int, int] = dict.fromkeys(possible, 0)
        for w in sorted(present & self.rank.keys(), key=self.rank.__getitem__):
            mine = [(k, p) for k, p in self.postings[w] if used.get(k, RARE_WORDS) < RARE_WORDS]
            for k, place in mine:
                for i in at[w]:
                    agree.setdefault((k, i - place), set()).add(w)
            for k in {k for k, _ in mine}:
                used[k] += 1
        yield from (key for key, found in agree.items() if len(found) >= self.agree[key[0]])

    def scan(self, text: str | None) -> tuple:
        words = scan_words(text)
        known = self.known
        at: dict[bytes, list[int]] = {}
        n_base, first, last, base = 0, None, None, set()
        for i, w in enumerate(words):
            if w in known:
                at.setdefault(w, []).append(i)
                for p, label in self.base.get(w, ()):
                    if tuple(words[i:i + len(p)]) == p:
                        n_base, first, last = n_base + 1, i if first is None else first, i
                        base.add(label)
        labels, score = set(base), 0.0
        for k, shift in self.candidates(at):
            template = self.words[k]
            here = words[max(0, shift):shift + len(template)]  # a file may begin or end inside a template
            equal = sum(a == b for a, b in zip(here, template[max(0, -shift):], strict=False))
            if equal >= self.templates[k].least * len(here) and all(_stands(here, p) for p in self.phrases[k]):
                labels.add(self.templates[k].label)
                score = max(score, equal / len(template))
        return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def frequencies(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[bytes, int], int]:
    """Number of documents that hold each template word, and of all documents.
    As many numbers as the templates have words come to the driver."""
    vocabulary = frozenset(w for t in templates for w in _phrase(t.text))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, counts = 0, dict.fromkeys(vocabulary, 0)
        for frame in frames:
            for t in frame["t"]:
                n += 1
                for w in vocabulary.intersection(scan_words(t)):
                    counts[w] += 1
        yield pd.DataFrame({"w": [*(w.decode() for w in counts), None], "n": [*counts.values(), n]})

    rows = docs.select(F.col(text).alias("t")).mapInPandas(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    found = {r["w"]: r["n"] for r in rows}
    return {w.encode(): n for w, n in found.items() if w is not None}, found.get(None, 0)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base (places of base
    phrases), first_word and last_word (the smallest and largest of them),
    base_labels, labels (base and template labels) and score (0 to 1)."""
    counts, n_docs = frequencies(docs, text, templates)
    idf = {w: math.log((1 + n_docs) / (1 + n)) for w, n in counts.items()}
    index = Index(templates, idf)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for frame in frames:
            out = pd.DataFrame([index.scan(t) for t in frame["t"]], columns=names)
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInPandas(run, schema)
