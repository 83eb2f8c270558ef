import random

import pytest

from shopmarts.llm import mixing as M


def targets(sizes, weights=(5, 2, 1), most=3.0):
    """Brute force: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        rate = left / sum(w[s] for s in open_)
        over = [s for s in open_ if rate * w[s] > most * sizes[s]]
        if not over:
            out |= {s: rate * w[s] for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 100, 10_000]) for s in ["a", "B", "é", "z", "zz", None]}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def corpus(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "a", "a", "b", "c", None]),
             "clash") for i in range(n)]
    rows += [(None, "x y z", "a", "q"), (5, None, None, "q"), (6, "", "d", "q")] + [rows[0]] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_taken_words_meet_the_targets(spark):
    docs = corpus(spark)
    rows = M.mix(docs, per_bucket=50).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert 0 <= r["copies"] <= 3
        b = by.setdefault((r["source_size"], r["target"]), [0, 0])
        b[0] += r["size"]
        b[1] += r["size"] * r["copies"]
    assert len(by) == 5
    for (size, target), (total, taken) in by.items():
        assert total == size and abs(taken - target) <= max(2, 0.002 * target)


def test_reruns_agree_and_the_mix_can_be_applied(spark):
    docs = corpus(spark, 200)
    key = lambda rows: sorted(map(str, rows))
    first = M.mix(docs, per_bucket=20)
    assert key(first.collect()) == key(M.mix(docs.repartition(5), per_bucket=20).collect())
    out = M.apply_mix(docs, first)
    assert out.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert words == sum(r["size"] * r["copies"] for r in first.collect())


def test_order_prefers_large_inclusion_odds(spark):
    rows = [(i, " ".join(["w"] * (100 if i % 2 else 10)), "a") for i in range(2000)]
    rows += [(5000 + i, "w " * 110, "b") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [r for r in M.mix(docs).collect() if r.doc_id < 5000]
    # the target of a is over twice its size: two certain copies, a sample of third ones
    third = lambda odd: sum(r.copies > 2 for r in taken if r.doc_id % 2 == odd)
    assert all(r.copies >= 2 for r in taken) and third(1) > third(0) > 0


def chances(sizes, extra):
    """Brute force: probabilities min(1, c * sqrt(size)) that give ``extra`` words."""
    lo, hi = 0.0, 10.0
    for _ in range(200):
        c = (lo + hi) / 2
        lo, hi = (c, hi) if sum(min(1, c * s ** .5) * s for s in sizes) < extra else (lo, c)
    return [min(1.0, hi * s ** .5) for s in sizes]


@pytest.mark.parametrize("share", [0.02, 0.4, 0.93])
def test_inclusion_probabilities_add_up(spark, share):
    rng = random.Random(3)
    sizes = [rng.choice([1, 3, 10, 50, 400]) for _ in range(500)]
    extra = share * sum(sizes)
    rows = [(None, s, sizes.count(s), extra) for s in set(sizes)] + [(None, 0, 7, extra)]
    df = spark.createDataFrame(rows, "source string, size long, n long, extra double")
    rate = M.inclusion_rates(df).first()["rate"]
    got = [min(1.0, rate * s ** .5) for s in sizes]
    assert abs(sum(p * s for p, s in zip(got, sizes)) - extra) < 1e-6 * extra
    assert all(abs(p - q) < 1e-9 for p, q in zip(got, chances(sizes, extra)))


def test_shares_taken_are_the_inclusion_probabilities(spark):
    sizes = [5, 20, 80, 700]
    rows = [(i, "w " * sizes[i % 4 if i % 40 == 3 or i % 4 < 3 else 0], "a") for i in range(8000)]
    rows += [(i, "w " * 50, "b") for i in range(8000, 14000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [r for r in M.mix(docs).collect() if r.doc_id < 8000]
    whole = int(taken[0].target // taken[0].source_size)
    extra = taken[0].target - whole * taken[0].source_size
    p = dict(zip((r.size for r in taken), chances([r.size for r in taken], extra)))
    for s in sizes:
        own = [r.copies - whole for r in taken if r.size == s]
        sd = (p[s] * (1 - p[s]) / len(own)) ** .5
        assert abs(sum(own) / len(own) - p[s]) <= 4 * sd + 2 / len(own)


def brute(rows, targets_, per_bucket):
    """The whole result: (id, hash) and copies of each row, from ``id, source, size, hash``."""
    out = []
    for source, target in targets_.items():
        own = [r for r in rows if r[1] == source]
        total = sum(r[2] for r in own)
        whole = int(target // total) if total else 0
        gap = target - whole * total
        p = chances([r[2] for r in own], gap) if gap > 0 else [0] * len(own)
        n = max(1, -(-len(own) // per_bucket))
        def place(r, q):
            u = (((r[3] % 2 ** 64) >> 11) + .5) / 2 ** 53
            if not (q > 0 and r[2]):
                return n - 1, 1.0, r[3]
            rank = u / (1 - u) * (1 - q) / q
            t = rank / (1 + rank)
            return (-1 if q == 1 else min(n - 1, int(t * n))), t, r[3]
        order = sorted((place(r, q), r) for r, q in zip(own, p))
        upto, cut = 0, None
        for (bucket, *_), r in order:
            upto += r[2]
            if upto > gap:
                cut = bucket
                break
        more, last = {k: 0 for k in range(len(order))}, cut
        while cut is not None and sum(cut <= o[0][0] <= last for o in order) < per_bucket and last < n - 1:
            last += 1
        for k, ((bucket, *_), r) in enumerate(order):
            if gap > 0 and 0 < r[2] and (cut is None or bucket <= last) and r[2] <= gap:
                more[k], gap = 1, gap - r[2]
        if cut is not None:
            left = [k for k in more if not more[k] and cut <= order[k][0][0] <= last and order[k][1][2]]
            best = min(left, key=lambda k: abs(order[k][1][2] - gap), default=None)
            if best is not None and abs(order[best][1][2] - gap) < gap:
                more[best] = 1
        out += [(r[0], r[3], whole + more[k]) for k, (_, r) in enumerate(order)]
    return sorted(out, key=str)


@pytest.mark.parametrize("per_bucket", [20, 10_000])
def test_whole_result_equals_brute_force(spark, per_bucket):
    docs = corpus(spark, 500, seed=4)
    rows = [(r.doc_id, r.source, len((r.text or "").split()), r.h) for r in
            docs.withColumn("h", M.row_hash(11, "doc_id", "text")).collect()]
    sizes = {}
    for r in rows:
        sizes[r[1]] = sizes.get(r[1], 0) + r[2]
    got = [(r.doc_id, r.row_hash, r.copies) for r in M.mix(docs, per_bucket=per_bucket).collect()]
    assert sorted(got, key=str) == brute(rows, targets(sizes), per_bucket)


def test_many_equal_rows_and_a_very_long_text(spark):
    rows = [(1, "same words here", "a")] * 3000 + [(2, "w " * 1_500_000, "b"), (3, "x y", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(docs).collect()
    assert len(got) == 3002 and {r.size for r in got} == {3, 2, 1_500_000}
    for r in got:
        assert 0 <= r.copies <= 3
    a = [r for r in got if r.source_size == 9002]
    assert abs(sum(r.size * r.copies for r in a) - a[0].target) <= 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(empty).collect() == []
    assert M.apply_mix(empty, M.mix(empty)).collect() == []
