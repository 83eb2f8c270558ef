from pyspark.sql import functions as F

from shopmarts.operators import marts, questions as Q, silver
from tests.fixtures import access, order, raw_frames, user


def _scenario(spark):
    users = [user(u, age=30 + u % 30) for u in range(1, 50)] + [user(995, age=44)]
    orders, oid = [], 0
    for m in range(24):  # user 42: one completed order every month, large totals
        oid += 1
        orders.append(order(oid, 42, f"{2024 + m // 12}-{m % 12 + 1:02d}-15", total=20000))
    for u in range(1, 10):
        oid += 1
        orders.append(order(oid, u, "2024-06-01", total=500))
    oid += 1
    orders.append(order(oid, 42, "2025-12-20", status="cancelled"))
    logs = [access(i, 995, ts=f"2025-11-{1 + i:02d} 03:00:00", event="page_view", threat="bot",
                   ip="192.0.2.1") for i in range(20)]
    logs += [access(100, 42, ts="2025-11-02 10:00:00")]
    s = silver.all_silver(raw_frames(spark, users=users, orders=orders, access_logs=logs))
    rfm = marts.customer_rfm(s["orders"], s["users"])
    risk = marts.user_risk(s["access_logs"], s["users"])
    return s, rfm, risk


def test_scenarios_42_and_995(spark):
    s, rfm, risk = _scenario(spark)
    c360 = Q.customer_360(s["users"], rfm, risk)
    got = {r.user_id: r for r in Q.response_decision(c360).collect()}
    assert (got[42].segment, got[42].rsk_cat, got[42].decision, got[42].points) == \
        ("優良顧客", "low", "compensate", 5000)
    assert got[995].segment is None
    assert (got[995].rsk_val, got[995].rsk_cat, got[995].decision) == (100, "critical", "freeze")
    c = {r.user_id: r for r in c360.collect()}
    assert c[995].has_purchase is False and c[995].frequency == 0
    assert c[1].rsk_val == 0 and c[1].rsk_cat == "low"  # no access rows: score 0, low


def test_relief_candidates(spark):
    s, rfm, risk = _scenario(spark)
    assert [r.user_id for r in Q.relief_candidates(rfm, s["orders"], risk).collect()] == [42]


def test_top_risk_users_tie_break(spark):
    df = spark.createDataFrame([(3, 10), (1, 10), (2, 30), (4, 5)], "usr_ref int, rsk_val long")
    assert [r.usr_ref for r in Q.top_risk_users(df, 3).collect()] == [2, 1, 3]


def test_category_sales_trend_gap_month(spark):
    ms = spark.createDataFrame(
        [("2024-01", "A", 100, 1), ("2024-02", "A", 150, 1), ("2024-04", "A", 300, 2)],
        "ym string, category string, sales_amount long, order_count long")
    got = {r.ym: r for r in Q.category_sales_trend(ms, "A").collect()}
    assert got["2024-01"].prev_sales_amount is None
    assert (got["2024-02"].prev_sales_amount, got["2024-02"].change_pct) == (100, 50.0)
    assert got["2024-04"].prev_sales_amount is None  # March is missing: no comparison


def test_top_categories_last_month(spark):
    ms = spark.createDataFrame(
        [("2025-12", c, v, 1) for c, v in [("A", 5), ("B", 9), ("C", 9), ("D", 1)]]
        + [("2025-11", "Z", 99, 1)],
        "ym string, category string, sales_amount long, order_count long")
    got = [(r.rank_no, r.category) for r in
           Q.top_categories_last_month(ms).orderBy("rank_no").collect()]
    assert got == [(1, "B"), (2, "C"), (3, "A")]


def test_abandonment_by_category_is_ratio_of_sums(spark):
    ca = spark.createDataFrame([("2025-01", "A", 10, 1), ("2025-02", "A", 90, 45)],
                               "ym string, category string, total_sessions long, abandons long")
    r = Q.abandonment_by_category(ca).first()
    assert r.abandonment_rate == 46.0  # 46 / 100, not the mean of 10% and 50%


def test_silent_churn_and_late_night(spark):
    rfm = spark.createDataFrame(
        [(1, 91, 1, 100, "離脱リスク", "30代", "x"), (2, 90, 1, 100, "離脱リスク", "30代", "x"),
         (3, 200, 1, 100, "休眠予備軍", "30代", "x")],
        "user_id long, recency_days int, frequency long, monetary long, segment string, "
        "age_group string, prefecture string")
    assert [r.user_id for r in Q.silent_churn(rfm).collect()] == [1]
    summ = spark.createDataFrame(
        [("2025-01", "bot", "深夜帯", 3), ("2025-01", "normal", "深夜帯", 5),
         ("2025-01", "bot", "午前", 7)], "period string, thr_cls string, tz_band string, evt_cnt long")
    assert [r.evt_cnt for r in Q.late_night_suspicious(summ).collect()] == [3]


def test_threat_trend_since(spark):
    te = spark.createDataFrame(
        [("2025-09", "bot", "a", 5, 0), ("2025-10", "bot", "a", 2, 1), ("2025-10", "bot", "b", 3, 0)],
        "period string, thr_cls string, src_addr string, evt_cnt long, fail_cnt long")
    r = Q.threat_trend_since(te).collect()
    assert [(x.period, x.evt_cnt, x.src_cnt) for x in r] == [("2025-10", 5, 2)]
    assert F is not None


def test_presentation_orders_and_labels(spark):
    from shopmarts.functions import presentation as P
    ms = spark.createDataFrame([("2024-02", "B", 1234567, 2, 1), ("2024-01", "Z", 5, 1, 1),
                                ("2024-02", "A", 10, 1, 1)],
                               "ym string, category string, sales_amount long, order_count long, "
                               "unique_buyers long")
    got = [(r.month, r.category, r.sales_yen) for r in P.presented_sales(ms).collect()]
    assert got == [("2024年01月", "Z", "5"), ("2024年02月", "A", "10"),
                   ("2024年02月", "B", "1,234,567")]
    te = spark.createDataFrame([("2025-11", "bot", "a", 3, 1), ("2025-11", "fraud", "b", 9, 2),
                                ("2025-10", "bot", "c", 1, 1)],
                               "period string, thr_cls string, src_addr string, evt_cnt long, "
                               "tgt_usr long")
    got = [(r.period, r.src_addr, r.threat) for r in P.presented_threat_events(te).collect()]
    assert got == [("2025-10", "c", "BOTアクセス"), ("2025-11", "b", "不正購入試行"),
                   ("2025-11", "a", "BOTアクセス")]


def test_reports_come_in_their_stated_order(spark):
    from shopmarts.plans.registry import QUERIES
    from tests.conftest import SF_SMALL

    keys = {"presented_sales": lambda r: (r.ym, r.category),
            "presented_risk": lambda r: (-r.rsk_val, r.usr_ref),
            "presented_threats": lambda r: (r.period, r.thr_cls, r.tz_band),
            "presented_threat_events": lambda r: (r.period, -r.evt_cnt, r.thr_cls, r.src_addr)}
    for name, key in keys.items():
        got = [key(r) for r in QUERIES[name](spark, SF_SMALL).collect()]
        assert len(got) > 1 and got == sorted(got), name
