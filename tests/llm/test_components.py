import random

from shopmarts.llm.components import connected_components


def brute(edges):
    low = {}
    for a, b in edges:
        low.setdefault(a, a)
        low.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def check(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"a {kind}, b {kind}")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == brute([e for e in edges if None not in e and e[0] != e[1]])


def test_path_star_random_and_odd_edges(spark):
    check(spark, [(i, i + 1) for i in range(120)])
    check(spark, [(500, i) for i in range(300)] + [(1000, 500)])
    rng = random.Random(1)
    check(spark, [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
          + [(1, 1), (None, 2), (3, None), (7, 8), (8, 7), (7, 8)])


def test_text_nodes_and_no_edges(spark):
    check(spark, [("b", "a"), ("c", "b"), ("x", "y")], "string")
    check(spark, [])
