import datetime as dt

from pyspark.sql import functions as F

from shopmarts.functions import buckets as B
from shopmarts.operators import marts, silver
from tests.fixtures import access, order, raw_frames, user

LATEST = dt.date(2025, 12, 31)


def _silver(spark, **rows):
    return silver.all_silver(raw_frames(spark, **rows))


def _day(days_before):
    return str(LATEST - dt.timedelta(days=days_before))


def test_rfm_recency_frequency_monetary_edges(spark):
    users, orders, oid = [], [], 0

    def add(uid, dates, total=1000):
        nonlocal oid
        users.append(user(uid))
        for d in dates:
            oid += 1
            orders.append(order(oid, uid, d, total=total))

    add(1, [_day(0)])
    recency = {30: 5, 31: 4, 90: 4, 91: 3, 180: 3, 181: 2, 365: 2, 366: 1}
    for i, days in enumerate(recency):
        add(10 + i, [_day(days)])
    freq = {10: 5, 9: 4, 6: 4, 5: 3, 3: 3, 2: 2, 1: 1}
    for i, n in enumerate(freq):
        add(30 + i, [_day(0)] * n)
    money = {100000: 5, 99999: 4, 50000: 4, 49999: 3, 20000: 3, 19999: 2, 10000: 2, 9999: 1}
    for i, m in enumerate(money):
        add(50 + i, [_day(0)], total=m)
    # a cancelled order after the latest completed one must not move "latest"
    orders.append(order(999, 1, "2026-01-15", status="cancelled"))
    orders.append(order(998, 4242, _day(0)))  # unknown user: dropped by the inner join
    s = _silver(spark, users=users, orders=orders)
    rfm = {r.user_id: r for r in marts.customer_rfm(s["orders"], s["users"]).collect()}
    assert 4242 not in rfm
    for i, (days, score) in enumerate(recency.items()):
        assert (rfm[10 + i].recency_days, rfm[10 + i].r_score) == (days, score)
    for i, (n, score) in enumerate(freq.items()):
        assert (rfm[30 + i].frequency, rfm[30 + i].f_score) == (n, score)
    for i, (m, score) in enumerate(money.items()):
        assert (rfm[50 + i].monetary, rfm[50 + i].m_score) == (m, score)
    assert all(3 <= r.rfm_total <= 15 for r in rfm.values())


def test_rfm_user_without_completed_order_has_no_row(spark):
    s = _silver(spark, users=[user(1), user(2)],
                orders=[order(1, 1, "2025-01-01"), order(2, 2, "2025-01-01", status="returned")])
    assert [r.user_id for r in marts.customer_rfm(s["orders"], s["users"]).collect()] == [1]


def test_segment_edges(spark):
    totals = {13: "優良顧客", 12: "成長顧客", 10: "成長顧客", 9: "休眠予備軍", 7: "休眠予備軍",
              6: "離脱リスク", 3: "離脱リスク"}
    df = spark.createDataFrame([(t,) for t in totals], "t int")
    got = {r.t: r.s for r in df.select("t", B.segment(F.col("t")).alias("s")).collect()}
    assert got == totals


def test_monthly_sales(spark):
    s = _silver(spark, orders=[order(1, 1, "2024-02-29", total=100),
                               order(2, 1, "2024-02-01", total=300),
                               order(3, 2, "2024-02-03", total=200),
                               order(4, 2, "2024-02-03", total=999, status="cancelled")])
    r = marts.monthly_sales(s["orders"]).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.ym, r.sales_amount, r.order_count, r.unique_buyers, r.avg_order_value) == \
        ("2024-02", 600, 3, 2, 200.0)


def test_cart_abandonment_rates(spark):
    rows, sid = [], 0

    def add(ym_day, category, events):
        nonlocal sid
        for e in events:
            sid += 1
            rows.append((sid, 1, 1, category, e, ym_day))

    add("2025-01-05", "A", ["view"] * 4 + ["add_to_cart"] * 2 + ["purchase", "abandon"])
    add("2025-01-05", "B", ["abandon"] + ["view"] * 14 + ["something_else"])
    s = _silver(spark, sessions=rows)
    got = {r.category: r for r in marts.cart_abandonment(s["sessions"]).collect()}
    a, b = got["A"], got["B"]
    assert (a.total_sessions, a.views, a.add_to_carts, a.purchases, a.abandons) == (8, 4, 2, 1, 1)
    assert (a.abandonment_rate, a.purchase_rate) == (12.5, 12.5)
    assert (b.total_sessions, b.views, b.abandons, b.abandonment_rate) == (16, 14, 1, 6.3)


KINDS = [  # (uid, success, event, threat, expected contribution)
    (1, 1, "login", "normal", 0), (2, 0, "login", "normal", 1),
    (3, 1, "login", "brute_force", 3), (4, 0, "login", "brute_force", 4),
    (5, 1, "page_view", "bot", 5), (6, 1, "purchase_attempt", "fraud", 10),
    (7, 0, "purchase_attempt", "fraud", 11), (8, None, "login", "normal", 0),
    (9, 1, "login", None, 0),
]


def _kind_logs():
    return [access(i, uid, success=s, event=e, threat=t) for i, (uid, s, e, t, _) in enumerate(KINDS)]


def test_risk_contributions_and_left_join(spark):
    s = _silver(spark, users=[user(u) for u in range(1, 9)], access_logs=_kind_logs())
    risk = {r.usr_ref: r for r in marts.user_risk(s["access_logs"], s["users"]).collect()}
    for uid, *_, want in KINDS:
        assert risk[uid].rsk_val == want, uid
    assert risk[9].name is None and risk[9].rsk_cat == "low"  # unknown user keeps its row
    assert risk[8].acc_cnt == 1 and risk[8].fail_cnt == 0


def test_risk_level_edges(spark):
    vals = {50: "critical", 49: "high", 20: "high", 19: "medium", 5: "medium", 4: "low", 0: "low"}
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = {r.v: r.c for r in df.select("v", B.risk_level(F.col("v")).alias("c")).collect()}
    assert got == vals


def test_access_summary_and_threat_events_nulls(spark):
    s = _silver(spark, access_logs=_kind_logs())
    summary = marts.access_summary(s["access_logs"])
    tot = summary.agg(F.sum("evt_cnt"), F.sum("succ_cnt"), F.sum("fail_cnt")).first()
    assert tuple(tot) == (9, 5, 3)  # the NULL-success row is in evt_cnt only
    assert summary.filter(F.col("thr_cls").isNull()).count() == 1
    te = marts.threat_events(s["access_logs"])
    assert te.filter(F.col("thr_cls").isNull()).count() == 0
    assert te.agg(F.sum("evt_cnt")).first()[0] == 5
    assert set(te.columns) >= {"period", "thr_cls", "src_addr", "first_dt", "last_dt"}


def test_threat_events_sum_equals_non_normal_summary(spark):
    s = _silver(spark, access_logs=_kind_logs() + [
        access(100 + i, 3, ts=f"2025-0{1 + i % 3}-02 0{i % 9}:00:00", threat="bot",
               ip=f"192.0.2.{i % 2}") for i in range(12)])
    summary = marts.access_summary(s["access_logs"]).filter(F.col("thr_cls") != "normal")
    te = marts.threat_events(s["access_logs"])
    assert summary.agg(F.sum("evt_cnt")).first()[0] == te.agg(F.sum("evt_cnt")).first()[0]
