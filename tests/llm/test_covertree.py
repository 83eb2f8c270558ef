import random

import numpy as np
import pandas as pd
import pytest

from shopmarts.llm import covertree as C


def brute(rows, least=0.93):
    """``rows``: (id, vector, label); (n_links, smallest id reachable) of each."""
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v)
        ok = ok and any(x != 0 for x in v)
        unit.append(np.array(v, np.float32).astype(float) if ok else None)
    part, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    low = {}
    for (k, _, _), p in zip(rows, part):
        if k is not None:
            low[p] = min(low.get(p, k), k)
    return [(links[k], low.get(part[k])) for k in range(n)]


def vectors(seed, n=260, dim=8):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    while k < n:
        center = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 2, 12]))):
            v = center + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.2])
            rows.append((k, [float(np.float32(x)) for x in v], int(rng.choice([0, 0, 1, 2]))))
            k += 1
    rows += [(n + 50, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2]), (None, rows[3][1], rows[3][2]),
             (n + 51, None, 0), (n + 52, [0.0] * dim, 0), (n + 53, [float("nan")] * dim, 0),
             (n + 54, [float("inf")] + [0.0] * (dim - 1), 0), (n + 55, [None] + [1.0] * (dim - 1), 0),
             (n + 56, rows[5][1], None), (n + 57, [], 1), (n + 58, [1.0, 2.0], 1), (n + 59, [1.0, 2.0], 1),
             (n + 60, [1e-30] * dim, 1), (n + 61, [1e-30] * dim, 1)]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,cells", [(1, 1024, 64), (2, 16, 6), (3, 8, 3)])
def test_links_and_components_equal_brute_force(spark, seed, block, cells):
    rows = vectors(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "vec_id long, embedding array<float>, label int, kept string")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept)
                 for r in C.near_duplicates(df, block=block, max_cells=cells).collect())
    want = []
    for (k, _, _), (links, low) in zip(rows, brute(rows)):
        want.append((str(k), links, str(low), k is not None and k == low))
    assert got == sorted(want)


def test_tree_nests_covers_and_separates():
    rng = np.random.default_rng(4)
    u = rng.normal(size=(700, 6))
    u /= np.linalg.norm(u, axis=1)[:, None]
    t = C.CoverTree(u)
    def below(k):
        return np.concatenate([t.points[k], *(below(c) for c in t.children[k])]).astype(int)
    assert sorted(below(0).tolist()) == list(range(700))
    for k in range(len(t.center)):
        pts = below(k)
        assert t.center[k] in pts
        assert np.linalg.norm(u[pts] - u[t.center[k]], axis=1).max() <= t.radius[k] + 1e-6
        if t.children[k]:
            assert t.center[t.children[k][0]] == t.center[k]
    assert len(t.children[0]) > 1


def test_dual_traversal_tests_few_pairs_on_clustered_points():
    rng = np.random.default_rng(5)
    v = np.repeat(rng.normal(size=(40, 6)), 40, axis=0) + rng.normal(size=(1600, 6)) * 0.01
    cell = C.Cell(v, np.ones(1600, np.int64), 0.999)
    tested, plain = [0], cell._pairs
    def counting(a, b, same):
        tested[0] += len(a) * len(b)
        plain(a, b, same)
    cell._pairs = counting
    cell.join(np.arange(1600), None)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    assert (cell.links == (unit @ unit.T >= 0.999).sum(axis=1) - 1).all()
    assert tested[0] < 1600 * 1600 / 8


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert C.near_duplicates(df).collect() == []


def test_a_label_lists_its_cell_pairs_not_its_sub_blocks():
    g = pd.DataFrame({"label": 1, "dim": 2, "cell": [0, 1, 2], "n": 10 ** 8, "r": [0.1, 0.1, 0.1],
                      "parts": 100_000, "p": [[[1.0, 0.0], [0.999, 0.04], [-1.0, 0.0]]] * 3})
    out = C.cell_pairs(g, 0.1)
    assert list(zip(out["a"], out["b"])) == [(0, 0), (0, 1), (1, 1), (2, 2)]
    assert set(out["a_parts"]) == set(out["b_parts"]) == {100_000}
