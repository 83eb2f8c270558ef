import random

from pyspark.sql import functions as F

from shopmarts.operators import distincts as D
from shopmarts.operators import silver
from tests.conftest import SF_SMALL
from tests.fixtures import access, raw_frames


def logs(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [access(i, rng.choice([None, 1, 2, 3, 70_000, 70_001, -5, 2_000_000_000]),
                   ts=f"2025-{rng.randint(1, 12):02d}-05 {rng.randint(0, 23):02d}:00:00",
                   ip=rng.choice([None, "10.0.0.1", "10.0.0.2", "fe80::1", "odd"]),
                   threat=rng.choice(["normal", "bot", "fraud"])) for i in range(n)]
    return silver.all_silver(raw_frames(spark, access_logs=rows))["access_logs"]


def test_numbers_are_dense(spark):
    df = spark.createDataFrame([(f"v{i % 57}",) for i in range(500)] + [(None,)], "c string").repartition(9)
    got = D.dense_numbers(df, "c").collect()
    assert sorted(r.number for r in got) == list(range(1, 58))
    assert len({r.value for r in got}) == 57


def test_counts_equal_count_distinct_at_every_level(spark):
    df = logs(spark)
    state = D.access_state(df)
    for keys in (D.ACCESS_KEYS, ["ym"], ["threat_type", "time_zone"], ["time_zone"], []):
        want = {tuple(r) for r in df.groupBy(*keys).agg(
            F.countDistinct("user_id"), F.countDistinct("ip_address")).collect()}
        got = {tuple(r) for r in D.distinct_counts(state, keys, ["uniq_usr", "uniq_src"]).collect()}
        # a group with neither users nor sources has no state
        assert got == {w for w in want if w[-2:] != (0, 0)}


def test_states_of_parts_merge_in_any_order(spark):
    df = logs(spark).withColumn("n", F.col("user_id"))
    part = lambda cond: D.distinct_state(df.filter(cond), ["ym"], {"users": F.col("n")})
    parts = [part("ym < '2025-05'"), part("ym >= '2025-03'"), part("threat_type = 'bot'")]
    whole = {tuple(r) for r in D.distinct_counts(D.distinct_state(df, ["ym"], {"users": F.col("n")}),
                                                 ["ym"], ["users"]).collect()}
    for order in (parts, parts[::-1]):
        got = D.distinct_counts(D.merged(*order), ["ym"], ["users"])
        assert {tuple(r) for r in got.collect()} == whole


def test_the_state_is_one_scan_without_expand(spark):
    from shopmarts.plans.shop import Shop
    state = D.distinct_state(Shop(spark, SF_SMALL).silver["access_logs"], ["ym"],
                             {"users": F.col("user_id")})
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_empty_log(spark):
    assert D.access_rollups(D.access_state(logs(spark, 0))).collect() == []
