"""Growing the lower part of a tree inside one task (used by ``trees``).

A node with few rows is grown to its end by the same splits as the level-wise
build: all values of every feature, gains equal to 9 decimals decided by the
feature's index and then the lower value. With few classes all nodes of a
level are split at once (``_grow_levels``): rows are counted by node, value and
class, so a level costs a few passes over its rows, however many nodes it has.
Otherwise nodes are split one by one: each feature of a node is sorted once; the
impurities of both sides change from value to value by the classes that it holds, so
a split costs the sort, however many classes there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd

TIE_DIGITS = 9
NOISE = 1e-12
CLASSES = 32            # more are split node by node
BATCH = 50_000          # nodes that leave a task at once
SCHEMA = ("node string, depth int, col string, vnum double, vstr string, is_leaf boolean, keys array<string>, counts array<long>, "
          "n long, mean double, var double")


def _term(score: str, x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x * np.log2(np.where(x > 0, x, 1.0)) if score == "entropy" else x * x


def _impurity(score: str, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    n = np.asarray(n, np.float64)
    return np.log2(n) - s / n if score == "entropy" else 1.0 - s / (n * n)


class _Classes:
    """Gains for labels."""

    def __init__(self, label: pd.Series, score: str):
        self.score = score
        self.codes, names = pd.factorize(label, use_na_sentinel=False)
        self.names = ["null" if x is None or x != x else str(x) for x in names]

    def gains(self, rows: np.ndarray, held: np.ndarray, starts: np.ndarray, running: bool) -> tuple[np.ndarray, np.ndarray]:
        """(size of the true side, gain) of each candidate. ``held`` are the
        rows with a value in the order of the candidates, of which the i-th
        begins at ``starts[i]``; with ``running`` its true side has all rows
        up to its own, else its own alone."""
        score, codes = self.score, self.codes[held]
        totals = np.bincount(self.codes[rows], minlength=len(self.names))
        n, whole = len(rows), _term(score, totals).sum()
        group = np.zeros(len(held), np.int64) if running else np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(held))))
        # how many of its class (and group) each row is the last of
        order = np.lexsort((np.arange(len(held)), codes, group))
        key = group[order] * len(self.names) + codes[order]
        first = np.append(True, key[1:] != key[:-1])
        place = np.arange(len(held)) - np.maximum.accumulate(np.where(first, np.arange(len(held)), 0))
        nth = np.empty(len(held), np.int64)
        nth[order] = place + 1
        t = totals[codes]
        s1, d2 = _term(score, nth) - _term(score, nth - 1), _term(score, t - nth) - _term(score, t - nth + 1)
        n1, s1, d2 = np.add.reduceat(np.ones(len(held), np.int64), starts), np.add.reduceat(s1, starts), np.add.reduceat(d2, starts)
        if running:
            n1, s1, d2 = np.cumsum(n1), np.cumsum(s1), np.cumsum(d2)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = n1 / n
            gain = _impurity(score, n, whole) - p * _impurity(score, n1, s1) - (1 - p) * _impurity(score, n - n1, whole + d2)
        return n1, gain

    def leaf(self, rows: np.ndarray) -> tuple:
        counts: dict[str, int] = {}
        for c, n in zip(*np.unique(self.codes[rows], return_counts=True), strict=True):
            counts[self.names[c]] = counts.get(self.names[c], 0) + int(n)
        keys = sorted(counts)
        return keys, [counts[k] for k in keys], len(rows), None, None


class _Moments:
    """Gains for numbers, by variance; rows without a target count as rows."""

    def __init__(self, target: pd.Series):
        self.y = target.to_numpy(np.float64, na_value=np.nan)

    def gains(self, rows: np.ndarray, held: np.ndarray, starts: np.ndarray, running: bool) -> tuple[np.ndarray, np.ndarray]:
        every, y = np.nan_to_num(self.y[rows]), np.nan_to_num(self.y[held])
        n, s, q = len(rows), every.sum(), (every * every).sum()
        n1, s1, q1 = np.add.reduceat(np.ones(len(held), np.int64), starts), np.add.reduceat(y, starts), np.add.reduceat(y * y, starts)
        if running:
            n1, s1, q1 = np.cumsum(n1), np.cumsum(s1), np.cumsum(q1)

        def var(n, s, q):
            return np.maximum(q / n - (s / n) ** 2, 0.0)

        with np.errstate(divide="ignore", invalid="ignore"):
            p = n1 / n
            return n1, var(n, s, q) - p * var(n1, s1, q1) - (1 - p) * var(n - n1, s - s1, q - q1)

    def leaf(self, rows: np.ndarray) -> tuple:
        y = self.y[rows]
        y = y[~np.isnan(y)]
        return None, None, len(rows), float(y.mean()) if len(y) else None, float(y.var()) if len(y) else None


def _best(target, columns: list, rows: np.ndarray) -> tuple | None:
    """(feature, value, rows of the true side as a mask) of the best split."""
    best = None
    for i, (values, numeric) in enumerate(columns):
        x = values[rows]
        keep = ~np.isnan(x) if numeric else x >= 0
        order = np.argsort(-x[keep] if numeric else x[keep], kind="stable")
        v = x[keep][order]
        if not len(v):
            continue
        starts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        n1, gain = target.gains(rows, rows[keep][order], starts, numeric)
        gain = np.where((n1 > 0) & (n1 < len(rows)) & (gain > NOISE), gain, -np.inf)
        rounded = np.round(gain, TIE_DIGITS)
        top = rounded.max()
        if top > -np.inf and (best is None or top > best[0]):
            best = top, i, v[starts[rounded == top]].min()
    if best is None:
        return None
    _, i, value = best
    x = columns[i][0][rows]
    return i, value, x >= value if columns[i][1] else x == value


def class_gains(score: str, total: np.ndarray, c1: np.ndarray) -> np.ndarray:
    """Gain of candidates from the class counts of their node and true side (a
    class a row, a candidate a column); -inf if a side is empty or it is noise."""

    def term(c: np.ndarray) -> np.ndarray:
        c = c.astype(np.float64)
        return c * np.log2(np.maximum(c, 1.0)) if score == "entropy" else c * c

    n, n1 = total.sum(axis=0), c1.sum(axis=0)
    whole, s1, s2 = (sum(term(c) for c in side) for side in (total, c1, total - c1))
    with np.errstate(divide="ignore", invalid="ignore"):
        p = n1 / n
        gain = _impurity(score, n, whole) - p * _impurity(score, n1, s1) - (1 - p) * _impurity(score, n - n1, s2)
        return np.where((n1 > 0) & (n1 < n) & (gain > NOISE), gain, -np.inf)


def best_of_runs(node: np.ndarray, gain: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, largest rounded gain, its lowest value) of each run of ``node``."""
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    rounded = np.round(gain, TIE_DIGITS)
    top = np.maximum.reduceat(rounded, starts)
    held = rounded == np.repeat(top, np.diff(np.append(starts, len(node))))
    return node[starts], top, np.minimum.reduceat(np.where(held, value, np.inf), starts)


def count_classes(node: np.ndarray, code: np.ndarray, y: np.ndarray, n_nodes: int, span: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, code, class counts): a column of counts for each code below
    ``span`` that a node has, in their order."""
    key = (node.astype(np.int64) * span + code) * width + y
    if n_nodes * span * width <= 2 * len(key):
        counts = np.bincount(key, minlength=n_nodes * span * width).reshape(-1, width)
        some = np.flatnonzero(counts.any(axis=1))
        return some // span, some % span, counts[some].T
    key.sort()
    ends = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    group, of = np.divmod(key[ends], width)
    first = np.append(True, group[1:] != group[:-1])
    place = np.cumsum(first) - 1
    counts = np.zeros((width, place[-1] + 1 if len(place) else 0), np.int64)
    counts[of, place] = np.diff(np.append(-1, ends))
    return group[first] // span, group[first] % span, counts


def running(node: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Running sums along the columns, begun anew at every node."""
    run = np.cumsum(counts, axis=1)
    head = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    return run - np.repeat((run - counts)[:, head], np.diff(np.append(head, len(node))), axis=1)


def _coded(values: np.ndarray, numeric: bool) -> tuple[np.ndarray, np.ndarray]:
    """(codes, values by code), numbers from the largest down; -1 is missing."""
    if not numeric:
        return values, np.arange(values.max(initial=-1) + 1, dtype=np.float64)
    held = ~np.isnan(values)
    known, at = np.unique(values[held], return_inverse=True)
    codes = np.full(len(values), -1, np.int64)
    codes[held] = len(known) - 1 - at
    return codes, known[::-1]


def _grow_levels(names: list[str], node: np.ndarray, y: np.ndarray, classes: list[str], columns: list, score: str, max_depth: int | None) -> Iterator[tuple]:
    """(node, depth, feature or -1, value or its text's code, counts by class
    name, rows) of ``names``, to which ``node`` deals the rows, and all below."""
    width = len(classes)
    coded = [_coded(*c) for c in columns]
    code = np.stack([c for c, _ in coded])

    def leaf(name: str, counts: np.ndarray) -> tuple:
        got: dict[str, int] = {}
        for k in np.flatnonzero(counts):
            got[classes[k]] = got.get(classes[k], 0) + int(counts[k])
        return name, len(name) - 1, -1, None, got, int(counts.sum())

    while names:
        total = np.bincount(node * width + y, minlength=len(names) * width).reshape(-1, width)
        may = (total > 0).sum(axis=1) > 1
        if max_depth is not None:
            may &= np.array([len(name) <= max_depth for name in names])
        top, feature, at = np.full(len(names), -np.inf), np.full(len(names), -1), np.zeros(len(names))
        able = may[node]
        some, y_of = node[able], y[able]
        for i, (_, known) in enumerate(coded):
            c = code[i][able]
            held = c >= 0
            if not held.any():
                continue
            of, v, counts = count_classes(some[held], c[held], y_of[held], len(names), len(known), width)
            if columns[i][1]:
                counts = running(of, counts)
            of, gain, low = best_of_runs(of, class_gains(score, total[of].T, counts), known[v])
            better = gain > top[of]
            of = of[better]
            top[of], feature[of], at[of] = gain[better], i, low[better]
        yield from (leaf(names[g], total[g]) for g in np.flatnonzero(feature < 0))
        split = np.flatnonzero(feature >= 0)
        yield from ((names[g], len(names[g]) - 1, int(feature[g]), at[g], None, int(total[g].sum())) for g in split)
        # the code of a split's value: sides are told by codes
        cut = np.zeros(len(names), np.int64)
        for i, (_, known) in enumerate(coded):
            here = feature == i
            cut[here] = len(known) - 1 - np.searchsorted(known[::-1], at[here]) if columns[i][1] else at[here]
        numeric = np.array([c[1] for c in columns])[feature]
        stay = feature[node] >= 0
        node, y, code = node[stay], y[stay], code[:, stay]
        c = code[feature[node], np.arange(len(node))]
        side = np.where(numeric[node], (c >= 0) & (c <= cut[node]), c == cut[node])
        child = np.zeros(len(names), np.int64)
        child[split] = 2 * np.arange(len(split))
        node = child[node] + ~side
        names = [names[g] + s for g in split for s in "TF"]


def grower(features: list[str], numeric: list[bool], label: str, score: str, max_depth: int | None) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function from the rows of some nodes, whose names tell their depth, to
    the rows of the node table for them and all below them."""

    def grow(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if not held:
            return
        pdf = pd.concat(held, ignore_index=True)
        held.clear()
        target = _Moments(pdf[label]) if score == "variance" else _Classes(pdf[label], score)
        columns, names = [], {}
        for i, (f, num) in enumerate(zip(features, numeric, strict=True)):
            if num:
                columns.append((pdf[f].to_numpy(np.float64, na_value=np.nan), True))
            else:
                codes, names[i] = pd.factorize(pdf[f], sort=True)
                columns.append((codes, False))

        at_root, roots = pd.factorize(pdf["node"])

        def levels() -> Iterator[tuple]:
            for node, at, i, value, counts, n in _grow_levels(list(roots), at_root, target.codes, target.names, columns, score, max_depth):
                if i < 0:
                    keys = sorted(counts)
                    yield node, at, None, None, None, True, keys, [counts[k] for k in keys], n, None, None
                    continue
                vnum, vstr = (float(value), None) if numeric[i] else (None, names[i][int(value)])
                yield node, at, features[i], vnum, vstr, False, None, None, n, None, None

        def nodes() -> Iterator[tuple]:
            todo = [(root, len(root) - 1, np.flatnonzero(at_root == k)) for k, root in enumerate(roots)]
            while todo:
                node, at, rows = todo.pop()
                best = _best(target, columns, rows) if max_depth is None or at < max_depth else None
                if best is None:
                    yield (node, at, None, None, None, True, *target.leaf(rows))
                    continue
                i, value, side = best
                vnum, vstr = (float(value), None) if numeric[i] else (None, names[i][value])
                yield node, at, features[i], vnum, vstr, False, None, None, len(rows), None, None
                todo += [(node + "T", at + 1, rows[side]), (node + "F", at + 1, rows[~side])]

        found = levels() if score != "variance" and len(target.names) <= CLASSES else nodes()
        while some := list(islice(found, BATCH)):
            yield pd.DataFrame(some, columns=[c.split()[0] for c in SCHEMA.split(", ")], dtype=object)

    return grow


def walker(nodes: pd.DataFrame, num: list[bool], root: str) -> Callable[..., pd.Series]:
    """A function from feature columns to the names of the nodes that rows
    reach from ``root`` by the splits (node, col_idx, vnum, vstr) of ``nodes``; a
    missing value goes to the false side."""
    names = nodes["node"].tolist()
    place = {n: i for i, n in enumerate(names)}
    ends: dict[str, int] = {}
    child = [np.array([place[c] if (c := n + side) in place else -1 - ends.setdefault(c, len(ends)) for n in names], np.int64) for side in "FT"]
    start = place[root] if root in place else -1 - ends.setdefault(root, len(ends))
    reached = np.array(list(ends), object)
    texts = pd.Index(nodes["vstr"].dropna().unique())
    feature = nodes["col_idx"].to_numpy(np.int64)
    numeric = np.array(num)[feature]
    value = np.where(numeric, nodes["vnum"].to_numpy(np.float64, na_value=np.nan), texts.get_indexer(nodes["vstr"]) if len(texts) else -1)

    def walk(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy(np.float64, na_value=np.nan) if n else (texts.get_indexer(c) - 0.0 if len(texts) else np.full(len(c), -1.0))
                      for c, n in zip(columns, num, strict=True)])
        g = np.full(len(columns[0]), start, np.int64)
        todo = np.flatnonzero(g >= 0)
        while len(todo):
            at = g[todo]
            v = x[feature[at], todo]
            true = np.where(numeric[at], v >= value[at], v == value[at])
            g[todo] = np.where(true, child[1][at], child[0][at])
            todo = todo[g[todo] >= 0]
        return pd.Series(reached[-1 - g], dtype=object)

    return walk


def _entropy(counts: Iterable[int]) -> float:
    c = np.array(list(counts), np.float64)
    return float(np.log2(c.sum()) - (c * np.log2(c)).sum() / c.sum())


def pruner(min_gain: float, parity: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A function from nodes (node, is_leaf, keys, counts) of one part of a
    tree to its changes: (node, keys, counts) of each pair's parent that is
    now a leaf, without keys for a node that is gone."""

    def prune(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf = {n: None if k is None else dict(zip(k, c, strict=True)) for n, x, k, c in zip(pdf["node"], pdf["is_leaf"], pdf["keys"], pdf["counts"], strict=True) if x}
        gone, merged = [], set()
        for n in sorted(pdf["node"][~pdf["is_leaf"].astype(bool)], key=len, reverse=True):
            t, f = leaf.get(n + "T"), leaf.get(n + "F")
            if not t or not f:
                continue
            both = {k: t.get(k, 0) + f.get(k, 0) for k in t | f}
            ht, hf = _entropy(t.values()), _entropy(f.values())
            delta = _entropy(both.values()) - ((ht + hf / 2) if parity else (ht + hf) / 2)
            if delta < min_gain:
                leaf[n] = both
                merged.add(n)
                gone += [n + "T", n + "F"]
        out = [(n, None, None) for n in gone] + [(n, sorted(leaf[n]), [int(leaf[n][k]) for k in sorted(leaf[n])]) for n in merged - set(gone)]
        return pd.DataFrame(out, columns=["node", "keys", "counts"], dtype=object)

    return prune
