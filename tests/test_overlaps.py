import random

from shopmarts.operators import overlaps as O

SCHEMA = "trace_id string, span_id int, agent string, start_ms long, end_ms long"


def brute(rows, key):
    """Depth by depth, millisecond by millisecond."""
    out = {}
    for k in {r[key] for r in rows if r[key] is not None}:
        own = [(r[3], r[4]) for r in rows if r[key] == k and None not in (r[3], r[4]) and r[3] < r[4]]
        if not own:
            continue
        for t in range(min(a for a, _ in own), max(b for _, b in own)):
            d = sum(a <= t < b for a, b in own)
            ms, first = out.get((k, d), (0, t))
            out[k, d] = (ms + 1, first)
    return out


def spans(n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randrange(400)
        # one trace holds most calls
        rows.append((rng.choice(["hot"] * 6 + ["b", "c"]), i, f"a{i % 3}", start, start + rng.randrange(30)))
    rows += rows[:5] + [("late", 0, "a0", 5000, 5010), ("late", 1, "a0", 5050, 5060), (None, 0, None, 1, 2),
                        ("odd", 0, "a1", 9, 3), ("odd", 1, "a1", None, 3), ("none", 0, "a1", 7, 7)]
    return rows


def test_depths_equal_brute_force_with_a_hot_trace_in_many_pieces(spark):
    rows = spans()
    for key, at in (("trace_id", 0), ("agent", 2)):
        got = O.overlap_depths(spark.createDataFrame(rows, SCHEMA).repartition(7), key).collect()
        assert {(r[key], r.depth): (r.ms, r.first_at) for r in got} == brute(rows, at)


def test_a_hot_trace_spans_tasks(spark, monkeypatch):
    seen, plain = [], O.ordered_pieces

    def watched(*args):
        seen.append(plain(*args))
        return seen[-1]

    monkeypatch.setattr(O, "ordered_pieces", watched)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        O.overlap_depths(spark.createDataFrame(spans(3000), SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    hot = seen[0].filter("trace_id = 'hot'").groupBy("piece").count().collect()
    total = sum(r["count"] for r in hot)
    assert len(hot) > 3 and max(r["count"] for r in hot) < total / 2


def test_parallelism(spark):
    rows = [("t", 1, "a", 0, 10), ("t", 2, "a", 4, 6), ("t", 3, "b", 5, 12), ("t", 4, "b", 12, 13),
            ("t", 5, "b", 20, 21)]
    r = O.parallelism(O.overlap_depths(spark.createDataFrame(rows, SCHEMA))).first()
    assert (r.peak, r.peak_at, r.busy_ms, r.parallel_ms, r.idle_ms) == (3, 5, 14, 6, 7)


def test_empty(spark):
    assert O.parallelism(O.overlap_depths(spark.createDataFrame([], SCHEMA))).collect() == []
