import math

import numpy as np
import pytest

from shopmarts.llm import bidiagonal as B
from shopmarts.llm import whitening as W
from tests.conftest import SF_SMALL


def orthogonal(rng, n):
    return np.linalg.qr(rng.standard_normal((n, n)))[0]


def spectra():
    yield "random", np.random.default_rng(1).standard_normal((40, 40))
    yield "one", np.array([[3.0]])
    yield "zero", np.zeros((5, 5))
    yield "identity", np.eye(6)
    yield "diagonal", np.diag([1.0, 1, 1, 2, 2, 0, 0])
    for k, d in enumerate(([1.0] * 30, [5.0] * 4 + [1.0] * 26, list(10.0 ** -np.arange(30)),
                           list(1 + 1e-9 * np.arange(30)), [3.0] * 2 + [0.0] * 28,
                           list(1 + 1e-14 * np.arange(30)), [1e8] * 3 + [1.0] * 27)):
        rng = np.random.default_rng(k)
        yield f"spectrum {k}", orthogonal(rng, 30) @ np.diag(d) @ orthogonal(rng, 30)
    yield "graded", np.linalg.qr(np.vander(np.linspace(0, 1, 25)), mode="r")


@pytest.mark.parametrize("name,m", list(spectra()))
def test_directions_against_numpy(name, m):
    values, v = B.principal_directions(m, len(m))
    want = np.linalg.svd(m, compute_uv=False)
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(v.T @ v - np.eye(len(m))).max() < 1e-12
    assert np.abs(m.T @ (m @ v) - v * values ** 2).max() <= 1e-12 * top ** 2
    few = B.principal_directions(m, 3)[1]
    assert np.allclose(few, v[:, :3], atol=1e-14)


@pytest.mark.parametrize("seed", range(4))
def test_bidiagonal_form(seed):
    m = np.random.default_rng(seed).standard_normal((12, 12))
    d, e, w = B.bidiagonalise(m)
    b = np.diag(d) + np.diag(e, 1)
    assert np.allclose(w.T @ w, np.eye(12), atol=1e-14)
    assert np.allclose(m.T @ m, w @ b.T @ b @ w.T, atol=1e-12)


def test_tiny_values_keep_their_digits():
    """dqds is accurate for each value by itself, not only beside the largest: for
    a graded bidiagonal the product of the values is that of the diagonal."""
    a = 10.0 ** -np.arange(0, 60, 4.0)
    values = B.dqds(a, a[:-1] * 0.5)
    assert math.isclose(np.log(values).sum(), np.log(a).sum(), rel_tol=1e-14)
    assert (values > 0).all()


def brute(vectors, k=8):
    """All rows of the contract in plain numpy; vectors are ``id, list``."""
    rows = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in rows], np.int64)
    n, s = len(x), [sum(int(v) for v in col) for col in x.T]
    centred = np.array([[n * int(c) - t for c, t in zip(v, s)] for v in x.tolist()], np.float64) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x.tolist()]
    trace = float((centred ** 2).sum() / n)
    return [r[0] for r in rows], n, dev, centred @ u / np.sqrt(e), e / trace



def compare(got, want):
    ids, n, dev, white, explained = want
    k = white.shape[1]
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(ids) * k == len(by)
    for c in range(k):
        mine = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine - sign * white[:, c]).max() < 1e-7
        assert all(math.isclose(by[i, c + 1].explained, explained[c], rel_tol=1e-9) for i in ids)
    for i, d in zip(ids, dev):
        assert by[i, 1].deviation == by[i, k].deviation == d


@pytest.mark.parametrize("parts", [1, 7, 150])
def test_whole_result_equals_brute_force(spark, parts):
    rng = np.random.default_rng(parts)
    data = rng.standard_normal((400, 12)) @ rng.standard_normal((12, 12)) * rng.uniform(0.1, 2, 12) + 1
    vectors = [(i, v.tolist()) for i, v in enumerate(data)]
    vectors += [(500, vectors[0][1]), (501, None), (502, [float("nan")] + [0.0] * 11),
                (503, [float("inf")] + [0.0] * 11), (504, [None] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors],
                               "vec_id long, embedding array<double>, component string")
    df = df.repartition(parts, "vec_id")
    model = W.fit(df)
    got = W.whiten(df, model).collect()
    assert model.n == 401
    compare(got, brute(vectors))
    assert W.identity_error(df, model) < 1e-9


def test_query_on_all_embeddings(spark):
    import __spark_entry__
    vectors = [(r.vec_id, r.embedding) for r in
               spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = __spark_entry__.queries()["op11_whitening"](spark, SF_SMALL).collect()
    compare(got, brute(vectors))
    assert {r.n for r in got} == {len(vectors)} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-4


def test_few_rows_ties_and_other_lengths(spark):
    # three vectors of two dimensions, one of them twice; a length of its own; an empty one
    df = spark.createDataFrame(
        [(None, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 5.0]), (3, [1.0]), (4, [])],
        "vec_id long, embedding array<float>")
    model = W.fit(df)
    got = W.whiten(df, model).collect()
    assert model.n == 3 and sorted((str(r.vec_id), r.component) for r in got) == [
        ("1", 1), ("1", 2), ("2", 1), ("2", 2), ("None", 1), ("None", 2)]
    # all on one line: the second direction has no spread
    assert all(r.whitened == 0 for r in got if r.component == 2)
    x = sorted(r.whitened for r in got if r.component == 1)
    assert math.isclose(x[0], x[1]) or math.isclose(x[1], x[2])
    assert math.isclose(sum(v * v for v in x) / 3, 1)


def test_one_vector_no_vector_and_huge_entries(spark):
    schema = "vec_id long, embedding array<double>"
    one = spark.createDataFrame([(1, [0.5, 2.0])], schema)
    got = W.whiten(one, W.fit(one)).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in got] == [(0.0, 0.0, 0)] * 2
    for rows in ([], [(1, None)], [(1, [None])], [(1, [])]):
        df = spark.createDataFrame(rows, schema)
        assert W.fit(df) is None and W.whiten(df, None).collect() == []
    huge = spark.createDataFrame([(k, [1e300 if k % 2 else -1e300, float(k)]) for k in range(4)], schema)
    model = W.fit(huge)
    got = W.whiten(huge, model).collect()
    assert len(got) == 8 and all(math.isfinite(r.whitened) for r in got)
    assert all(r.deviation is None for r in got)      # over a long


def test_merging_in_many_levels(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    rng = np.random.default_rng(5)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((90, 5)))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(23)
    model = W.fit(df, components=5)
    compare(W.whiten(df, model).collect(), brute(vectors, 5))
    assert W.identity_error(df, model) < 1e-12
