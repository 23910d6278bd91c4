from collections import defaultdict

import pytest

from quarry.llm import line_dedup as L


def brute(rows, min_sites):
    sites, first = defaultdict(set), {}
    for d, t, _, s in rows:
        for i, x in enumerate((t or "").split("\n") if t is not None else []):
            k = x.strip("\t\n\x0b\x0c\r ")
            if k:
                if s is not None:
                    sites[k].add(s)
                place = (d is None, d if d is not None else 0, i)
                first[k] = min(first.get(k, place), place)
    out = []
    for d, t, _, s in rows:
        if t is None:
            out.append((d, None))
            continue
        keep = []
        for i, x in enumerate(t.split("\n")):
            k = x.strip("\t\n\x0b\x0c\r ")
            if not k or len(sites[k]) < min_sites or first[k] == (d is None, d if d is not None else 0, i):
                keep.append(x)
        out.append((d, "\n".join(keep)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [2, 3, 10])
def test_matches_brute_force(docs_of, awkward, min_sites):
    rows = [(*r, *("en", "s0")[len(r) - 2:]) if len(r) < 4 else r for r in awkward]
    for i in range(100, 160):
        text = f"only here {i}\n  shared by many\nby few {i % 7}\n\nshared by many\nnear {i % 5}"
        rows.append((i, text, "en", None if i % 9 == 0 else f"s{i % 12}"))
    got = sorted(((r["doc_id"], r["text"]) for r in L.remove(docs_of(rows), min_sites).collect()), key=repr)
    assert got == brute(rows, min_sites)


def test_first_copy_stays_and_counts(docs_of):
    rows = [(i, f"menu line\nown {i}", "en", f"s{i}") for i in range(5)]
    got = {r["doc_id"]: r for r in L.remove(docs_of(rows), 5).collect()}
    assert got[0]["text"] == "menu line\nown 0" and got[3]["text"] == "own 3"
    assert [got[i]["n_removed"] for i in range(5)] == [0, 1, 1, 1, 1] and got[2]["n_lines"] == 2
    assert got[1]["k1"] == "x-k1"


def test_near_threshold_lines_are_counted_exactly(docs_of):
    n = 400  # the sketch alone may be off by some sites here
    rows = [(i, "on all sites" + ("\non one site less" if i else ""), "en", f"site {i}") for i in range(n)]
    got = L.remove(docs_of(rows), n).collect()
    assert sum(r["n_removed"] for r in got) == n - 1


def test_empty_table(docs_of):
    assert L.remove(docs_of([])).count() == 0
