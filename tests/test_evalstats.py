from shopmarts.operators import evalstats as E


def _spans(spark):
    return spark.createDataFrame(
        [("t1", 1, "sales", 0, 5), ("t1", 2, "security", 3, 9), ("t1", 3, "docs", 10, 12),
         ("t2", 1, "sales", 0, 4), ("t2", 2, "docs", 4, 8)],
        "trace_id string, span_id int, agent string, start_ms long, end_ms long")


def test_call_profile_overlap_and_slowest(spark):
    got = {(r.trace_id, r.span_id): r for r in E.trace_call_profile(_spans(spark)).collect()}
    assert [got[("t1", i)].overlaps_prior for i in (1, 2, 3)] == [False, True, False]
    assert [got[("t1", i)].is_slowest for i in (1, 2, 3)] == [False, True, False]
    assert [got[("t1", i)].seq for i in (1, 2, 3)] == [1, 2, 3]
    # t2: equal durations, the lower span id is the slowest; touching spans do not overlap
    assert got[("t2", 1)].is_slowest and not got[("t2", 2)].overlaps_prior


def test_latency_profile(spark):
    got = {r.agent: r for r in E.latency_profile(_spans(spark)).collect()}
    assert (got["sales"].calls, got["sales"].p50_ms, got["sales"].max_ms) == (2, 4.5, 5)
    assert got["security"].slowest_traces == 1 and got["security"].slowest_share_pct == 50.0
    assert got["docs"].slowest_traces == 0


def test_pass_rate_and_run_comparison(spark):
    v = spark.createDataFrame(
        [("r1", "a", "relevance", "pass"), ("r1", "b", "relevance", "fail"),
         ("r1", "c", "relevance", None), ("r2", "a", "relevance", "pass"),
         ("r2", "b", "relevance", "pass")],
        "run_id string, trace_id string, judge string, verdict string")
    r = E.pass_rate(v).first()
    assert (r.n, r.passed, r.failed, r.empty, r.pass_pct) == (5, 3, 1, 1, 75.0)
    cmp = {x.run_id: x for x in E.run_comparison(v).collect()}
    assert (cmp["r1"].pass_pct, cmp["r2"].pass_pct, cmp["r2"].delta_pct) == (50.0, 100.0, 50.0)


def test_evaluation_dataset(spark):
    traces = spark.createDataFrame([("a", "q1"), ("b", "q2"), ("c", "q3")],
                                   "trace_id string, request string")
    sel = spark.createDataFrame([("a",), ("a",), ("c",)], "trace_id string")
    labels = spark.createDataFrame([("a", "good")], "trace_id string, label string")
    got = sorted((r.trace_id, r.label) for r in E.evaluation_dataset(traces, sel, labels).collect())
    assert got == [("a", "good"), ("c", None)]


def test_call_profile_chunked_equals_whole_trace(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for t in range(3):
        n = [40, 7, 1][t]
        for i in range(n):
            st = rnd.randint(0, 200)
            rows.append((f"t{t}", i, f"a{i % 3}", st, st + rnd.randint(0, 30)))
    rows.append(("t0", 99, "dup", 50, 90))  # same start as others: ties by span id
    spans = spark.createDataFrame(
        rows, "trace_id string, span_id int, agent string, start_ms long, end_ms long")
    whole = sorted(map(tuple, E.trace_call_profile(spans).collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunked = sorted(map(tuple, E.trace_call_profile(spans).collect()))
        pieces = E.ordered_pieces(spans, ["trace_id"], ["start_ms", "span_id"], "test")
        split = pieces.filter("trace_id = 't0'").select("piece").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert whole == chunked and split > 3     # the large trace lies in several pieces
    # and against a direct definition
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    want = set()
    for t, rs in by.items():
        rs.sort(key=lambda r: (r[3], r[1]))
        slow = sorted(rs, key=lambda r: (-(r[4] - r[3]), r[1]))[0][1]
        mx = None
        for i, r in enumerate(rs):
            want.add((t, r[1], i + 1, mx is not None and r[3] < mx, r[1] == slow))
            mx = r[4] if mx is None else max(mx, r[4])
    got = {(r[0], r[1], r[6], r[7], r[8]) for r in chunked}
    assert got == want


def test_percentiles_equal_the_direct_definition_on_any_split(spark):
    import random
    rnd = random.Random(11)
    rows = [(f"t{i % 9}", i, f"a{i % 2}", 0, rnd.choice([1, 5, 5, 7, 900, i])) for i in range(101)]
    spans = spark.createDataFrame(
        rows, "trace_id string, span_id int, agent string, start_ms long, end_ms long")
    got = {r.agent: r for r in E.latency_profile(spans).collect()}
    for a in ("a0", "a1"):
        d = sorted(r[4] for r in rows if r[2] == a)
        for q, v in ((0.5, got[a].p50_ms), (0.95, got[a].p95_ms)):
            place = q * (len(d) - 1)
            low = d[int(place)]
            high = d[min(int(place) + 1, len(d) - 1)]
            assert abs(v - (low + (place - int(place)) * (high - low))) < 1e-6
        assert (got[a].calls, got[a].max_ms) == (len(d), d[-1])
