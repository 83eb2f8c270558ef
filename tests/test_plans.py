"""Physical-plan regressions: pushdown, pruning, co-located joins, map-side top-k."""

import uuid

from shopmarts.operators import marts, questions
from shopmarts.plans import pipeline as PL
from shopmarts.plans.shop import Shop
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _written(spark, buckets=None):
    db = f"p_{uuid.uuid4().hex[:8]}"
    PL.run_pipeline(spark, Shop(spark, SF_SMALL).raw, db, comments=False, user_buckets=buckets)
    return db


def test_filter_and_columns_reach_the_silver_scan(spark):
    db = _written(spark)
    plan = _plan(marts.monthly_sales(spark.table(f"{db}.silver_orders")))
    assert "EqualTo(status,completed)" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "channel" not in scan and "order_date" not in scan


def test_bucketed_user_tables_join_without_shuffle(spark):
    db = _written(spark, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = PL.customer_360_from_tables(spark, db)
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.count() == spark.table(f"{db}.silver_users").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_k_per_group_limits_before_the_shuffle(spark):
    ms = Shop(spark, SF_SMALL).monthly_sales()
    plan = questions.top_categories_by_month(ms)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_date_is_a_scalar_subquery_not_a_collect(spark):
    plan = _plan(marts.rfm_base(Shop(spark, SF_SMALL).silver["orders"]))
    assert "Subquery" in plan


def test_no_python_udfs_in_headline_plans(spark):
    from __spark_entry__ import queries
    qs = queries()
    for k in ("customer_rfm", "access_summary", "user_risk", "customer_360", "dq_order_total",
              "vector_topk", "trace_call_profile", "passages"):
        plan = _plan(qs[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, k


def test_marts_aggregate_map_side_before_every_shuffle(spark):
    """In the aggregation-only marts, every hash exchange is fed directly by a
    partial aggregate: a hot key is combined inside every map task before
    anything is shuffled."""
    from __spark_entry__ import queries
    qs = queries()
    for k in ("monthly_sales", "rfm_base", "cart_abandonment", "access_summary",
              "threat_events", "risk_counters"):
        lines = [ln for ln in _plan(qs[k](spark, SF_SMALL)).splitlines() if ln.strip()]
        exchanges = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
        assert exchanges, k
        for i in exchanges:
            below = lines[i + 1]
            assert "HashAggregate" in below and "partial_" in below, (k, below)


def test_access_marts_shuffle_at_most_twice_and_read_the_log_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shop = Shop(spark, SF_SMALL)
        for df in (shop.risk_counters(), shop.access_summary(), shop.threat_events(), shop.monthly_sales()):
            plan = _plan(df)
            assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("FileScan") == 1
        # the latest date over all users is no second aggregation by user
        assert _plan(shop.rfm_base()).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_query_opens_only_the_tables_it_reads(spark):
    shop = Shop(spark, SF_SMALL)
    shop.silver["users"].schema
    assert {"customer", "nation"} == set(vars(shop.t)) - {"spark", "sf_dir"}
