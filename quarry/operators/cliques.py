"""Maximal cliques of any graph table (inventory G9, G10, H12).

Vertices are ordered by repeated peeling: every round takes the vertices whose
degree among those left is at most ``1 + SLACK`` times the mean, so rounds are
logarithmic and a vertex has at most ``2 (1 + SLACK)`` times the core number of
the graph as later neighbours, however many neighbours it has in all. A clique
belongs to its first vertex. Per edge the later neighbours that both ends share
are one array; a task searches, among the later neighbours of one vertex, for
the cliques that no earlier vertex extends. A vertex whose later neighbours
have many edges among them is dealt out to several tasks by the clique's second
member, so that the number of tasks follows the work.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarry.operators.graph import undirected, vertices
from quarry.session import cut_lineage

SLACK = 0.1
TASK_EDGES = 20_000
BATCH = 10_000


def peel(edges: DataFrame) -> DataFrame:
    """(id, turn): the round in which each vertex is peeled off. Two numbers a
    round reach the driver."""
    left, turn, out = cut_lineage(undirected(edges)), 0, None
    while True:
        degree = cut_lineage(left.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")))
        mean = degree.agg(F.avg("n")).first()[0]
        if mean is None:
            break
        gone = degree.where(F.col("n") <= (1 + SLACK) * mean).select("id")
        part = gone.select("id", F.lit(turn).alias("turn"))
        out = part if out is None else out.unionByName(part)
        left = cut_lineage(left.join(gone.select(F.col("id").alias("src")), "src", "left_anti")
                           .join(gone.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst"))
        turn += 1
    # a vertex whose neighbours all went before it has no edge left to be counted by
    every = vertices(edges.where("src <> dst"))
    if out is None:
        return every.select("id", F.lit(0).alias("turn"))
    return cut_lineage(every.join(out, "id", "left").select("id", F.coalesce("turn", F.lit(turn)).alias("turn")))


def shared_later(edges: DataFrame) -> DataFrame:
    """(a, b, later): every edge with a before b, and the later neighbours that
    the two share."""
    order = peel(edges)
    e = undirected(edges)
    e = (e.join(order.select(F.col("id").alias("src"), F.struct("turn", "id").alias("ps")), "src")
         .join(order.select(F.col("id").alias("dst"), F.struct("turn", "id").alias("pd")), "dst"))
    first = F.col("ps") < F.col("pd")
    e = cut_lineage(e.select(F.when(first, F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(first, F.col("dst")).otherwise(F.col("src")).alias("b")))
    after = cut_lineage(e.groupBy("a").agg(F.collect_list("b").alias("next")))
    none = F.array().cast(after.schema["next"].dataType)
    return (e.join(after, "a").join(after.select(F.col("a").alias("b"), F.col("next").alias("then")), "b", "left")
            .select("a", "b", F.array_intersect("next", F.coalesce("then", none)).alias("later")))


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


def _search(near: list[int], starts: Iterator[int], earlier: set[int]) -> Iterator[int]:
    """Cliques as masks over the members 0..n-1 of a neighbourhood with
    adjacency ``near``, whose least member is one of ``starts``, that neither a
    member nor one of the neighbour sets ``earlier`` extends."""
    for i in starts:
        todo = [(1 << i, near[i] >> i + 1 << i + 1, near[i] & (1 << i) - 1, {m & near[i] for m in earlier if m >> i & 1})]
        while todo:
            clique, free, used, outer = todo.pop()
            if not free:
                if not used and not outer:
                    yield clique
                continue
            reach = [near[u] & free for u in _bits(free | used)] + [m & free for m in outer]
            pivot = max(reach, key=int.bit_count)
            for u in _bits(free & ~pivot):
                todo.append((clique | 1 << u, free & near[u], used & near[u], {m for m in outer if m >> u & 1}))
                free, used = free & ~(1 << u), used | 1 << u


def maximal_cliques(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(members), every maximal clique of two vertices or more as a sorted
    array. Direction, repeated edges and loops do not count."""
    rows = cut_lineage(shared_later(edges))
    load = rows.groupBy("a").agg((1 + F.floor(F.sum(F.size("later")) / F.lit(task_edges))).cast("int").alias("parts"))
    kind = rows.schema["a"].dataType.simpleString()
    mine = rows.select(F.col("a").alias("v"), F.col("b").alias("m"), "later", F.lit(True).alias("inner"))
    outer = (rows.where(F.size("later") > 0)
             .select(F.col("b").alias("v"), F.col("b").alias("m"), F.array_sort("later").alias("later"), F.lit(False).alias("inner")).distinct())
    dealt = (mine.unionByName(outer).join(load.withColumnRenamed("a", "v"), "v")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))

    # one row a task of the search: a call into Python takes many of them
    sought = dealt.groupBy("v", "part", "parts").agg(F.collect_list(F.struct("m", "later", "inner")).alias("x")).select(
        "v", "part", "parts", F.col("x.m").alias("m"), F.col("x.later").alias("later"), F.col("x.inner").alias("inner"))
    member = pa.list_(to_arrow_type(rows.schema["a"].dataType))

    def found(v, part: int, parts: int, ms: list, laters: list, inner: list) -> Iterator[list]:
        names = sorted(m for m, own in zip(ms, inner, strict=True) if own)
        at = {x: i for i, x in enumerate(names)}
        near, earlier = [0] * len(names), set()
        for m, later, own in zip(ms, laters, inner, strict=True):
            if not own:
                earlier.add(sum(1 << at[x] for x in later))
                continue
            for x in later:
                near[at[m]] |= 1 << at[x]
                near[at[x]] |= 1 << at[m]
        for c in _search(near, range(part, len(names), parts), earlier):
            yield sorted([v, *(names[i] for i in _bits(c))])

    def cliques(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = chain.from_iterable(found(*x) for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
        while some := list(islice(every, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(some, member)], ["members"])

    return sought.mapInArrow(cliques, f"members array<{kind}>")


def clique_statistics(cliques: DataFrame) -> DataFrame:
    """One row: n_cliques, mean_size (rounded down), largest, n_largest,
    and in_all_largest, the members that all the largest share, sorted."""
    sized = cliques.select("members", F.size("members").alias("size"))
    whole = sized.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    top = whole.agg(F.max("size").alias("largest"), F.max_by("n", "size").alias("n_largest"), F.sum("n").alias("n_cliques"),
                    F.floor(F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean_size"))
    row = cut_lineage(top)
    uses = (sized.join(F.broadcast(row.select(F.col("largest").alias("size"), "n_largest")), "size")
            .select(F.explode("members").alias("m"), "n_largest").groupBy("m", "n_largest").agg(F.count(F.lit(1)).alias("n")).where("n = n_largest"))
    shared = uses.groupBy("n_largest").agg(F.array_sort(F.collect_list("m")).alias("in_all_largest"))
    none = F.array().cast(cliques.schema["members"].dataType)
    return (row.join(shared, "n_largest", "left")
            .select("n_cliques", "mean_size", "largest", "n_largest", F.coalesce("in_all_largest", none).alias("in_all_largest")))
