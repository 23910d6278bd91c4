"""Splits of the large nodes of a tree, level by level (used by ``trees``).

The rows lie in parts that stay where they are from level to level. There is a
copy for every numeric feature of many values, dealt out by ranges of it, so
that a part's running sums need of the parts before it one sum per node.
Features of few values are counted. In a level rows move to their children, sums
per part and value are taken, and every part names its best split of each node.
A row adds 1 to its class, or for variance 1, y and y^2 to the moments.

Where the cluster has a core for every share of the parts, all levels are one
barrier stage: a task holds its share in memory (``TASK_ROWS`` at most) and the
tasks exchange sums per node and best splits, from which each finds the same tree.
An exchange takes about a second, so there is one a level where the sums of the
next level follow from the splits (one feature of many values, class counts).
Elsewhere a level is three small jobs that write the parts anew, and sums per node
and best splits reach the driver.
"""

from __future__ import annotations

import base64
import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.subtrees import NOISE, TIE_DIGITS
from quarry.session import cut_lineage

FEW = 64                # values of a counted feature
CLASSES = 32
PART_ROWS = 100_000
TASK_ROWS = 4_000_000   # rows, of all copies, that a task of the barrier stage holds
NODE_ROWS = 1_500_000   # rows of a node that a task grows a level at a time
STATE = "copy int, part int, g binary, y binary, x binary"


def _terms(score: str, n: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Impurity of sets with ``n`` rows and the sums ``c`` (one set a row)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if score == "variance":
            h = np.maximum(c[:, 2] / n - (c[:, 1] / n) ** 2, 0.0)
        elif score == "entropy":
            h = np.log2(n) - (c * np.log2(np.where(c > 0, c, 1.0))).sum(axis=1) / n
        else:
            h = 1.0 - (c * c).sum(axis=1) / (n * n)
    return np.where(n > 0, h, 0.0)


def _size(score: str, c: np.ndarray) -> np.ndarray:
    return c[:, 0] if score == "variance" else c.sum(axis=1)


def _best(score: str, node: np.ndarray, value: np.ndarray, c1: np.ndarray, total: np.ndarray) -> Iterator[tuple]:
    """(node, -rounded gain, value, gain, sums of the true side): of each node
    the largest gain, then the lowest value."""
    t = total[node]
    n, n1 = _size(score, t), _size(score, c1)
    p = n1 / n
    gain = _terms(score, n, t) - p * _terms(score, n1, c1) - (1 - p) * _terms(score, n - n1, t - c1)
    ok = np.flatnonzero((gain > NOISE) & (n1 > 0) & (n1 < n))
    rounded = -np.round(gain, TIE_DIGITS)
    order = ok[np.lexsort((value[ok], rounded[ok], node[ok]))]
    for i in order[np.append(True, node[order][1:] != node[order][:-1])] if len(order) else []:
        yield int(node[i]), float(rounded[i]), float(value[i]), float(gain[i]), c1[i].tolist()


class _Part:
    """One part: node, target and features of its rows, as read from a row."""

    def __init__(self, r, n_features: int):
        self.copy, self.part = int(r.copy), int(r.part)
        self.g, self.y = np.frombuffer(r.g, np.int64), np.frombuffer(r.y, np.float64)
        self.x = np.frombuffer(r.x, np.float64).reshape(n_features, -1)

    def weights(self, score: str, width: int) -> np.ndarray:
        if score == "variance":
            return np.stack([np.ones(len(self.y)), self.y, self.y * self.y], axis=1)
        return np.eye(width)[self.y.astype(np.int64)]


def _row(copy: int, part: int, g: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple:
    return copy, part, g.astype(np.int64).tobytes(), y.astype(np.float64).tobytes(), np.ascontiguousarray(x, np.float64).tobytes()


def _parts(frames: Iterable[pd.DataFrame], n_features: int) -> Iterator[_Part]:
    for frame in frames:
        for r in frame.itertuples(index=False):
            yield _Part(r, n_features)


class Levels:
    """The large nodes of one tree. ``usable`` is False where a feature or
    the label has too many values to be counted, or one value fills a part."""

    def __init__(self, rows: DataFrame, features: list[str], num: list[bool], label: str, score: str):
        self.features, self.num, self.score = features, num, score
        # NaN is missing, as in ``subtrees``
        number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        kinds = [number(c) if n else F.col(c).cast("string") for c, n in zip(features, num, strict=True)]
        self.kinds = [c.alias(f"f{i}") for i, c in enumerate(kinds)]
        y = F.col(label).cast("double" if score == "variance" else "string")
        some = lambda c: F.array_sort(F.collect_set(c))
        few = rows.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(c, 0.02).alias(f"d{i}") for i, c in enumerate([*kinds, y])]).first()
        self.n, n_classes = few["n"], few[f"d{len(features)}"]
        self.node_rows = NODE_ROWS if score != "variance" and n_classes < CLASSES else 0
        self.usable = False
        if self.n <= self.node_rows:
            return
        counted = [i for i in range(len(features)) if few[f"d{i}"] <= FEW]
        self.usable = all(num[i] or i in counted for i in range(len(features))) and (score == "variance" or n_classes < CLASSES)
        if not self.usable:
            return
        picks = {f"v{i}": some(kinds[i]) for i in counted} | ({} if score == "variance" else {"y": some(y)})
        values = rows.agg(*[c.alias(k) for k, c in picks.items()], F.lit(0).alias("_")).first()
        self.values = {i: list(values[f"v{i}"]) for i in counted}
        self.classes = [] if score == "variance" else list(values["y"])
        self.width = 3 if score == "variance" else len(self.classes) + 1
        self.wide = [i for i in range(len(features)) if i not in counted]
        self.rules = _Rules(num, score, self.values, self.width, self.wide)
        coded = [kinds[i] if num[i] else self._code(kinds[i], self.values[i]) for i in range(len(features))]
        target = F.coalesce(y, F.lit(0.0)) if score == "variance" else F.coalesce(self._code(y, self.classes), F.lit(float(len(self.classes))))
        x = rows.select(target.alias("y"), *[c.alias(f"f{i}") for i, c in enumerate(coded)])
        n_parts = max(1, -(-self.n // PART_ROWS))
        copies = [self._dealt(x.repartitionByRange(n_parts, F.desc(f"f{i}")), i) for i in self.wide] or [self._dealt(x.repartition(n_parts), -1)]
        self.state = copies[0]
        for c in copies[1:]:
            self.state = self.state.unionByName(c)
        self.state = cut_lineage(self.state)
        self.usable = (self.state.agg(F.max(F.length("g"))).first()[0] or 0) <= 4 * 8 * PART_ROWS

    @staticmethod
    def _code(c: Column, values: list) -> Column:
        place = F.array_position(F.array(*[F.lit(v) for v in values]), c) if values else F.lit(None)
        return F.when(c.isNotNull(), (place - 1).cast("double"))

    def _dealt(self, x: DataFrame, copy: int) -> DataFrame:
        names = [f"f{i}" for i in range(len(self.features))]

        def pack(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [f for f in frames if len(f)]
            if held:
                f = pd.concat(held)
                x = f[names].to_numpy(np.float64, na_value=np.nan).T
                yield pd.DataFrame([_row(copy, int(f["part"].iloc[0]), np.zeros(len(f)), f["y"].to_numpy(), x)], columns=["copy", "part", "g", "y", "x"])

        return x.withColumn("part", F.spark_partition_id()).mapInPandas(pack, STATE)

    def totals(self, open_nodes: int) -> tuple[np.ndarray, dict, dict]:
        """(sums per node, {(copy, part): sums per node of the parts before},
        {counted feature: (node, code, sums)}) of the current level."""
        rules = self.rules

        def sums(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in _parts(frames, len(rules.num)):
                yield from rules.sums(p, open_nodes)

        weights = [f"w{m}" for m in range(rules.width)]
        schema = "copy int, part int, i int, node long, code long, " + ", ".join(f"{w} double" for w in weights)
        out = self.state.mapInPandas(sums, schema).groupBy("copy", "part", "i", "node", "code").agg(*[F.sum(w).alias(w) for w in weights])
        return rules.merged(out.toPandas(), open_nodes)

    def splits(self, open_nodes: int) -> tuple[np.ndarray, dict]:
        """(sums per node, {node: (feature, value, sums of the true side)})."""
        total, before, counts = self.totals(open_nodes)
        rules = self.rules

        def search(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in _parts(frames, len(rules.num)):
                yield pd.DataFrame(list(rules.search(p, total, before)), columns=["node", "rank", "i", "value", "gain", "c"])

        schema = "node long, rank double, i int, value double, gain double, c array<double>"
        found = [tuple(r) for r in self.state.mapInPandas(search, schema).collect()] if rules.wide else []
        return total, rules.best([*rules.counted(total, counts), *found])

    def move(self, side: list, true_child: np.ndarray, false_child: np.ndarray) -> None:
        """Every row to its child; rows of a child below 0 leave."""
        rules = self.rules

        def moved(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in _parts(frames, len(rules.num)):
                if rules.move(p, side, true_child, false_child):
                    yield pd.DataFrame([_row(p.copy, p.part, p.g, p.y, p.x)], columns=["copy", "part", "g", "y", "x"])

        self.state = cut_lineage(self.state.mapInPandas(moved, STATE))

    def grown(self, root: str, max_depth: int | None, local_rows: int) -> tuple[list, list]:
        """(splits of the nodes of over ``local_rows`` rows, names of those that
        have none); a split is (node, depth, feature, number, text, rows)."""
        tasks = _cores(self.state.sparkSession)
        if not tasks or self.n * max(1, len(self.wide)) > tasks * TASK_ROWS:
            return _descend(self, self.rules, root, max_depth, local_rows)
        rules, n_features = self.rules, len(self.features)

        def grow(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = _Held(rules, list(_parts(frames, n_features)))
            found = _descend(held, rules, root, max_depth, local_rows)
            if BarrierTaskContext.get().partitionId() == 0:
                yield pd.DataFrame({"found": [pickle.dumps(found)]})

        out = self.state.repartition(tasks).mapInPandas(grow, "found binary", barrier=True)
        return pickle.loads(out.collect()[0]["found"])


def _cores(spark: SparkSession) -> int:
    """Tasks that can run at once; 0 if executors come and go, which a barrier
    stage does not allow, or if that number is not told."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    try:
        context = sc._jsc.sc()
        return min(sc.defaultParallelism, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))
    except Exception:
        return 0


class _Held:
    """The parts of one task of the barrier stage."""

    def __init__(self, rules: _Rules, parts: list[_Part]):
        self.rules, self.parts = rules, parts
        self.follow = len(rules.wide) < 2 and rules.score != "variance"
        self.total = self.before = None

    @staticmethod
    def _of_all(own: object) -> list:
        told = BarrierTaskContext.get().allGather(base64.b64encode(pickle.dumps(own)).decode())
        return [pickle.loads(base64.b64decode(x)) for x in told]

    def splits(self, open_nodes: int) -> tuple[np.ndarray, dict]:
        """As ``Levels.splits``."""
        rules = self.rules
        own = [f for p in self.parts for f in rules.sums(p, open_nodes, self.follow)]
        own = pd.concat(own, ignore_index=True) if own else None
        if self.before is None:
            told = self._of_all(own)
            total, before, counts = rules.merged(pd.concat(told, ignore_index=True), open_nodes)
            found = self._of_all(self._found(total, before))
        else:
            before = self.before
            told, found = zip(*self._of_all((own, self._found(self.total, before))), strict=True)
            total, _, counts = rules.merged(pd.concat(told, ignore_index=True), open_nodes)
        best = rules.best([*rules.counted(total, counts), *(b for some in found for b in some)])
        if self.follow:
            self.level = total, before, pd.concat(told, ignore_index=True), best
        return total, best

    def _found(self, total: np.ndarray, before: dict) -> list:
        return self.rules.best([b for p in self.parts for b in self.rules.search(p, total, before)], whole=True)

    def move(self, side: list, true_child: np.ndarray, false_child: np.ndarray) -> None:
        self.parts = [p for p in self.parts if self.rules.move(p, side, true_child, false_child)]
        if self.follow:
            self.total, self.before = self._next(true_child, false_child)

    def _next(self, true_child: np.ndarray, false_child: np.ndarray) -> tuple[np.ndarray, dict]:
        """Sums per node of the next level, and those of the parts before each
        part: a true side is the codes from its own on (or its own code), or of a
        range of values what its sums hold beyond the parts before."""
        total, before, told, best = self.level
        rules, weights = self.rules, [f"w{m}" for m in range(self.rules.width)]
        run, out = np.zeros((max(true_child.max(), false_child.max()) + 1, rules.width)), {}
        for part, f in told.groupby("part"):
            key = rules.wide[0] if rules.wide else -1, int(part)
            i, node, code, w = f["i"].to_numpy(), f["node"].to_numpy(), f["code"].to_numpy(), f[weights].to_numpy()
            sums = np.zeros_like(total)
            sums[node[i == -1]] = w[i == -1]
            out[key] = run.copy()
            for g, (feature, value, c1) in best.items():
                if feature in rules.values:
                    here = (i == feature) & (node == g)
                    true = w[here & (code >= value if rules.num[feature] else code == value)].sum(axis=0)
                else:
                    true = np.clip(c1 - before[key][g], 0, sums[g])
                for child, c in ((true_child[g], true), (false_child[g], sums[g] - true)):
                    if child >= 0:
                        run[child] += c
        return run, out


class _Rules:
    """What splitting a part needs to know of the tree (goes to the tasks)."""

    def __init__(self, num: list[bool], score: str, values: dict, width: int, wide: list[int]):
        self.num, self.score, self.values, self.width, self.wide = num, score, values, width, wide

    def sums(self, p: _Part, open_nodes: int, by_part: bool = False) -> Iterator[pd.DataFrame]:
        """Sums of a part by node, and once also by node and value of the
        counted features; with ``by_part`` the latter name their part."""
        w = p.weights(self.score, self.width)
        asked = [(-1, np.zeros(len(p.g), np.int64), 1)]
        if p.copy == (self.wide[0] if self.wide else -1):
            for i, v in self.values.items():
                code = p.x[i] if not self.num[i] else np.where(np.isnan(p.x[i]), np.nan, np.searchsorted(v, p.x[i]) if v else np.nan)
                asked.append((i, code, max(1, len(v))))
        for i, code, span in asked:
            held = ~np.isnan(code)
            key = p.g[held] * span + code[held].astype(np.int64)
            total = np.stack([np.bincount(key, weights=w[held, m], minlength=open_nodes * span) for m in range(self.width)], axis=1)
            some = np.flatnonzero(np.bincount(key, minlength=len(total)))
            named = i < 0 or by_part
            out = {"copy": p.copy if named else -1, "part": p.part if named else -1, "i": i, "node": some // span, "code": some % span}
            yield pd.DataFrame(out | {f"w{m}": total[some, m] for m in range(self.width)})

    def merged(self, out: pd.DataFrame, open_nodes: int) -> tuple[np.ndarray, dict, dict]:
        """What ``Levels.totals`` returns, from the sums of all parts."""
        weights = [f"w{m}" for m in range(self.width)]
        counted = out[out["i"] >= 0].groupby(["i", "node", "code"], as_index=False)[weights].sum()
        per_part = out[out["i"] == -1].sort_values(["copy", "part"])
        total, before = np.zeros((open_nodes, self.width)), {}
        for copy, one in per_part.groupby("copy"):
            total = np.zeros((open_nodes, self.width))
            for part, f in one.groupby("part"):
                before[int(copy), int(part)] = total.copy()
                total[f["node"]] += f[weights].to_numpy()
        counts = {int(i): (f["node"].to_numpy(), f["code"].to_numpy(), f[weights].to_numpy()) for i, f in counted.groupby("i")}
        return total, before, counts

    def counted(self, total: np.ndarray, counts: dict) -> Iterator[tuple]:
        """Best splits by the counted features."""
        for i, (node, code, c) in counts.items():
            order = np.lexsort((-code, node))
            node, code, c = node[order], code[order], c[order]
            if self.num[i]:
                head = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
                run = np.cumsum(c, axis=0)
                c = run - np.repeat((run - c)[head], np.diff(np.append(head, len(node))), axis=0)
            for b in _best(self.score, node, code.astype(np.float64), c, total):
                yield b[0], b[1], int(i), *b[2:]

    def search(self, p: _Part, total: np.ndarray, before: dict) -> Iterator[tuple]:
        """Best splits by the feature that a part is a range of."""
        v = p.x[p.copy] if self.wide else np.empty(0)
        held = np.flatnonzero(~np.isnan(v))
        # from the largest value down, then by node; the latter's few numbers sort fast as short integers
        held = held[np.argsort(-v[held], kind="stable")]
        g = p.g[held].astype(np.int16) if len(total) <= 32_767 else p.g[held]
        held = held[np.argsort(g, kind="stable")]
        if not len(held):
            return
        g, v, w = p.g[held], v[held], p.weights(self.score, self.width)[held]
        head = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        run = np.cumsum(w, axis=0)
        run = run - np.repeat((run - w)[head], np.diff(np.append(head, len(g))), axis=0) + before[p.copy, p.part][g]
        last = np.append((g[1:] != g[:-1]) | (v[1:] != v[:-1]), True)
        for b in _best(self.score, g[last], v[last], run[last], total):
            yield b[0], b[1], p.copy, *b[2:]

    @staticmethod
    def best(found: list, whole: bool = False) -> dict | list:
        """Of each node the split to take; with ``whole`` as it was found."""
        best: dict = {}
        for b in sorted(found, key=lambda b: (b[1], b[2], b[3])):
            best.setdefault(b[0], b)
        return list(best.values()) if whole else {node: (i, value, np.array(c)) for node, _, i, value, _, c in best.values()}

    def move(self, p: _Part, side: list, true_child: np.ndarray, false_child: np.ndarray) -> bool:
        """The part's rows to their children; whether any stay."""
        g = np.where(self.test(side, p.g, p.x), true_child[p.g], false_child[p.g])
        keep = g >= 0
        p.g, p.y, p.x = g[keep], p.y[keep], p.x[:, keep]
        return bool(keep.any())

    def test(self, side: list, g: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Of rows in nodes with the splits ``side`` (feature, value): whether
        each is on the true side; a missing value is not."""
        feature = np.array([s[0] for s in side], np.int64)
        value = np.array([self.values[s[0]][int(s[1])] if s[0] in self.values and self.num[s[0]] else s[1] for s in side], np.float64)
        numeric = np.array(self.num)[feature]
        v = x[feature[g], np.arange(len(g))]
        return np.where(numeric[g], v >= value[g], v == value[g])

    def split_values(self, i: int, value: float) -> tuple[float | None, str | None]:
        if i in self.values:
            value = self.values[i][int(value)]
        return (float(value), None) if self.num[i] else (None, value)


def _descend(levels: Levels | _Held, rules: _Rules, root: str, max_depth: int | None, local_rows: int) -> tuple[list, list]:
    """Level by level from the root, as long as nodes are large (``Levels.grown``)."""
    size = (lambda c: c[0]) if rules.score == "variance" else (lambda c: c.sum())
    inner, ended = [], []
    names, depth = [root], 0
    while names:
        if max_depth is not None and depth >= max_depth:
            ended += names
            break
        total, best = levels.splits(len(names))
        sides, nxt, child = [], [], {"T": [], "F": []}
        for g, name in enumerate(names):
            if g not in best:
                ended.append(name)
                sides.append((0, 0.0))
                child["T"].append(-1)
                child["F"].append(-1)
                continue
            i, value, c1 = best[g]
            sides.append((i, value))
            inner.append((name, depth, i, *rules.split_values(i, value), int(round(size(total[g])))))
            for side, c in (("T", c1), ("F", total[g] - c1)):
                if round(size(c)) > local_rows:
                    child[side].append(len(nxt))
                    nxt.append(name + side)
                else:
                    child[side].append(-1)
        if nxt:
            levels.move(sides, np.array(child["T"]), np.array(child["F"]))
        names, depth = nxt, depth + 1
    return inner, ended
