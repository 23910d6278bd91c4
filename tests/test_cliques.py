import random

from quarry.operators import cliques as Q


def brute(edges):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = set()

    def grow(clique, common):
        if not common:
            out.add(tuple(clique))
        for x in sorted(y for y in common if y > clique[-1]):
            grow([*clique, x], common & near[x])

    for v in near:
        grow([v], near[v])
    return out


def test_two_hundred_random_graphs(spark):
    """One table of 200 graphs side by side; ids say which graph."""
    rnd, edges = random.Random(5), []
    for g in range(200):
        n, p = rnd.randint(2, 14), rnd.choice([0.2, 0.5, 0.8, 1.0])
        edges += [(g * 100 + a, g * 100 + b) for a in range(n) for b in range(a + 1, n) if rnd.random() < p]
    edges += [(b, a) for a, b in edges[::3]] + [(7, 7), (99_999, 99_999)] + edges[:50]
    df = spark.createDataFrame(edges, "src long, dst long")
    for task_edges in (20_000, 3):
        got = [tuple(r["members"]) for r in Q.maximal_cliques(df, task_edges).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(edges)


def test_hub_with_many_neighbours(spark):
    """A hub's task holds few later neighbours, however many it has."""
    edges = [("hub", f"v{i:04d}") for i in range(3000)] + [(f"v{i:04d}", f"v{i + 1:04d}") for i in range(0, 3000, 3)]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert Q.shared_later(df).groupBy("a").count().agg({"count": "max"}).first()[0] <= 4
    assert {tuple(r["members"]) for r in Q.maximal_cliques(df).collect()} == brute(edges)


def test_statistics(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([2, 3, 4],), ([5, 6],)], "members array<long>")
    assert tuple(Q.clique_statistics(df).first()) == (3, 2, 3, 2, [2, 3])
    none = Q.maximal_cliques(spark.createDataFrame([], "src long, dst long"))
    assert none.count() == 0
    assert tuple(Q.clique_statistics(none).first()) == (None, None, None, None, [])


def test_many_neighbourhoods_share_a_call(spark):
    edges = spark.range(3000).selectExpr("inline(array(struct(id * 3 as src, id * 3 + 1 as dst), struct(id * 3 + 1 as src, id * 3 + 2 as dst), struct(id * 3 as src, id * 3 + 2 as dst)))")
    found = {tuple(r["members"]) for r in Q.maximal_cliques(edges).collect()}
    assert found == {(3 * i, 3 * i + 1, 3 * i + 2) for i in range(3000)}
