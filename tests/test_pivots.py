import numpy as np
import pytest

from shopmarts.operators import pivots as P

SCHEMA = "vec_id long, embedding array<float>"
QUERY = "query_id long, vector array<double>"


def clustered(rng, n=1200, centers=12, d=16, spread=0.03):
    c = rng.standard_normal((centers, d))
    return (c[rng.integers(0, centers, n)] + spread * rng.standard_normal((n, d))).astype(np.float32)


def brute(x, q, k):
    x, q = x.astype(np.float64), q.astype(np.float64)
    s = (q @ x.T) / np.linalg.norm(x, axis=1) / np.linalg.norm(q, axis=1)[:, None]
    out = set()
    for i, row in enumerate(s):
        for rank, j in enumerate(sorted(range(len(x)), key=lambda j: (-row[j], j))[:k]):
            out.add((i, rank + 1, j, round(float(row[j]), 6)))
    return out


def frames(spark, x, q):
    return (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA),
            spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], QUERY))


def same(got, want):
    got = {tuple(r) for r in got}
    assert {g[:3] for g in got} == {w[:3] for w in want}
    score = {w[:3]: w[3] for w in want}
    assert all(abs(g[3] - score[g[:3]]) <= 1.1e-6 for g in got)


def test_clustered_vectors_are_mostly_unscored(spark):
    rng = np.random.default_rng(3)
    x = clustered(rng)
    q = x[rng.integers(0, len(x), 6)] + 0.01 * rng.standard_normal((6, 16))
    corpus, queries = frames(spark, x, q)
    index = P.build(corpus, pivots=24)
    same(index.topk(queries, 5).collect(), brute(x, q, 5))
    scored = index.scored(index.final).count()
    assert scored < 0.25 * len(x) * len(q)


@pytest.mark.parametrize("pivots,k", [(1, 3), (7, 1), (40, 10), (500, 4)])
def test_equal_to_brute_force_whatever_the_pivots(spark, pivots, k):
    rng = np.random.default_rng(pivots)
    x = np.vstack([rng.standard_normal((90, 6)), rng.standard_normal((5, 6)).repeat(4, 0)]).astype(np.float32)
    q = rng.standard_normal((4, 6))
    corpus, queries = frames(spark, x, q)
    same(P.build(corpus, pivots=pivots).topk(queries, k).collect(), brute(x, q, k))


def test_few_null_zero_and_no_vectors(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 1.0])], SCHEMA)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], QUERY)
    got = sorted(tuple(r)[:3] for r in P.build(corpus).topk(queries, 5).collect())
    assert got == [(1, 1, 1), (1, 2, 4)]
    assert P.build(corpus.limit(0)).topk(queries, 5).collect() == []
