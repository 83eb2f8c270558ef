"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers its parquet tables as views (region, nation, customer, ...).
These strings rebuild the same pipeline in plain SQL: adapter CTEs (``b_*``),
silver CTEs (``s_*``), mart CTEs (``g_*``), then one final SELECT per query.
``sql(final, *ctes)`` prepends the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

_SHIFT = "ts + to_days(CAST(((event_id // 7) % 24) * 30 AS INTEGER))"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body.strip(), deps)


# ---------------------------------------------------------------- adapters (bronze)
cte("b_users", """
SELECT c_custkey AS user_id, c_name AS name, CAST(18 + c_custkey % 48 AS INTEGER) AS age,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, n_name AS prefecture,
       strftime(DATE '2023-01-01' + CAST(c_custkey % 701 AS INTEGER), '%Y-%m-%d') AS registration_date,
       'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
cte("b_products", """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(floor(p_retailprice) AS INTEGER) AS price,
       CAST(floor(p_retailprice / 2) AS INTEGER) AS cost
FROM part""")
cte("b_orders", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled'
                          WHEN 'P' THEN 'returned' END AS status,
       CAST(floor(o_totalprice / 10) AS INTEGER) AS total_amount,
       CASE o_orderkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' WHEN 2 THEN 'app' END AS channel,
       o_orderpriority AS category
FROM orders""")
cte("b_order_items", """
SELECT item_id, order_id, product_id, quantity,
       CAST(CASE WHEN quantity <> 0 THEN subtotal // quantity END AS INTEGER) AS unit_price, subtotal
FROM (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS item_id,
             l_orderkey AS order_id, l_partkey AS product_id,
             CAST(trunc(l_quantity) AS INTEGER) AS quantity,
             CAST(floor(l_extendedprice / 10) AS INTEGER) AS subtotal
      FROM lineitem)""")
cte("b_sessions", f"""
SELECT event_id AS session_id, user_id, event_id % 200 AS product_id,
       'cat' || CAST(event_id % 8 AS VARCHAR) AS category,
       CASE event_type WHEN 'view' THEN 'view' WHEN 'signup' THEN 'view'
                       WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'purchase'
                       WHEN 'error' THEN 'abandon' END AS event_type,
       strftime({_SHIFT}, '%Y-%m-%d') AS session_date
FROM events""")
cte("b_access_logs", f"""
SELECT event_id AS access_id, user_id, strftime({_SHIFT}, '%Y-%m-%d %H:%M:%S') AS timestamp,
       '198.51.100.' || CAST(event_id % 250 AS VARCHAR) AS ip_address,
       CASE event_id % 4 WHEN 0 THEN 'shop-web/desktop' WHEN 1 THEN 'shop-web/mobile'
                         WHEN 2 THEN 'shop-app/ios' WHEN 3 THEN 'shop-app/android' END AS user_agent,
       CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 0 ELSE 1 END AS success,
       CASE WHEN event_id % 200 = 0 THEN 'purchase_attempt' WHEN event_id % 100 = 1 THEN 'page_view'
            ELSE 'login' END AS event_type,
       CASE WHEN event_id % 200 = 0 THEN 'fraud' WHEN event_id % 100 = 1 THEN 'bot'
            WHEN event_id % 50 = 2 THEN 'brute_force' ELSE 'normal' END AS threat_type
FROM events""")

# ---------------------------------------------------------------- silver
cte("s_users", """
SELECT * REPLACE (CAST(registration_date AS DATE) AS registration_date),
       CASE WHEN age < 30 THEN '10-20代' WHEN age < 40 THEN '30代' WHEN age < 50 THEN '40代'
            ELSE '50代以上' END AS age_group
FROM b_users""", "b_users")
cte("s_products", "SELECT * FROM b_products", "b_products")
cte("s_orders", """
SELECT * REPLACE (CAST(order_date AS DATE) AS order_date),
       CAST(year(CAST(order_date AS DATE)) AS INTEGER) AS year,
       CAST(month(CAST(order_date AS DATE)) AS INTEGER) AS month,
       strftime(CAST(order_date AS DATE), '%Y-%m') AS ym
FROM b_orders""", "b_orders")
cte("s_order_items", "SELECT * FROM b_order_items", "b_order_items")
cte("s_sessions", """
SELECT * REPLACE (CAST(session_date AS DATE) AS session_date),
       strftime(CAST(session_date AS DATE), '%Y-%m') AS ym
FROM b_sessions""", "b_sessions")
cte("s_access_logs", """
SELECT * EXCLUDE (hour), hour,
       CASE WHEN hour BETWEEN 2 AND 5 THEN '深夜帯' WHEN hour BETWEEN 6 AND 11 THEN '午前'
            WHEN hour BETWEEN 12 AND 17 THEN '午後' ELSE '夜間' END AS time_zone
FROM (SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp),
             CAST(CAST(timestamp AS TIMESTAMP) AS DATE) AS access_date,
             CAST(hour(CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS hour,
             strftime(CAST(timestamp AS TIMESTAMP), '%Y-%m') AS ym
      FROM b_access_logs)""", "b_access_logs")

# ---------------------------------------------------------------- gold marts
cte("g_monthly_sales", """
SELECT ym, category, CAST(sum(total_amount) AS BIGINT) AS sales_amount,
       count(order_id) AS order_count, count(DISTINCT user_id) AS unique_buyers,
       avg(total_amount) AS avg_order_value
FROM s_orders WHERE status = 'completed' GROUP BY ym, category""", "s_orders")
cte("g_rfm_base", """
SELECT user_id,
       CAST(datediff('day', max(order_date),
            (SELECT max(order_date) FROM s_orders WHERE status = 'completed')) AS INTEGER) AS recency_days,
       count(order_id) AS frequency, CAST(sum(total_amount) AS BIGINT) AS monetary
FROM s_orders WHERE status = 'completed' GROUP BY user_id""", "s_orders")
cte("g_rfm_scores", """
SELECT *, CASE WHEN rfm_total >= 13 THEN '優良顧客' WHEN rfm_total >= 10 THEN '成長顧客'
               WHEN rfm_total >= 7 THEN '休眠予備軍' ELSE '離脱リスク' END AS segment
FROM (SELECT *, r_score + f_score + m_score AS rfm_total
      FROM (SELECT *,
              CASE WHEN recency_days <= 30 THEN 5 WHEN recency_days <= 90 THEN 4
                   WHEN recency_days <= 180 THEN 3 WHEN recency_days <= 365 THEN 2 ELSE 1 END AS r_score,
              CASE WHEN frequency >= 10 THEN 5 WHEN frequency >= 6 THEN 4
                   WHEN frequency >= 3 THEN 3 WHEN frequency >= 2 THEN 2 ELSE 1 END AS f_score,
              CASE WHEN monetary >= 100000 THEN 5 WHEN monetary >= 50000 THEN 4
                   WHEN monetary >= 20000 THEN 3 WHEN monetary >= 10000 THEN 2 ELSE 1 END AS m_score
            FROM g_rfm_base))""", "g_rfm_base")
cte("g_customer_rfm", """
SELECT r.*, u.age, u.age_group, u.gender, u.prefecture
FROM g_rfm_scores r JOIN s_users u ON r.user_id = u.user_id""", "g_rfm_scores", "s_users")
cte("g_cart_abandonment", """
SELECT *, round(abandons / total_sessions * 100, 1) AS abandonment_rate,
          round(purchases / total_sessions * 100, 1) AS purchase_rate
FROM (SELECT ym, category, count(session_id) AS total_sessions,
             CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
             CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS add_to_carts,
             CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
             CAST(sum(CASE WHEN event_type = 'abandon' THEN 1 ELSE 0 END) AS BIGINT) AS abandons
      FROM s_sessions GROUP BY ym, category)""", "s_sessions")
cte("g_access_summary", """
SELECT *, round(fail_cnt / evt_cnt * 100, 1) AS fail_pct
FROM (SELECT ym AS period, threat_type AS thr_cls, time_zone AS tz_band,
             count(access_id) AS evt_cnt,
             CAST(sum(CASE WHEN success = 1 THEN 1 ELSE 0 END) AS BIGINT) AS succ_cnt,
             CAST(sum(CASE WHEN success = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fail_cnt,
             count(DISTINCT ip_address) AS uniq_src, count(DISTINCT user_id) AS uniq_usr
      FROM s_access_logs GROUP BY ym, threat_type, time_zone)""", "s_access_logs")
cte("g_threat_events", """
SELECT ym AS period, threat_type AS thr_cls, ip_address AS src_addr, count(access_id) AS evt_cnt,
       CAST(sum(CASE WHEN success = 1 THEN 1 ELSE 0 END) AS BIGINT) AS succ_cnt,
       CAST(sum(CASE WHEN success = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fail_cnt,
       count(DISTINCT user_id) AS tgt_usr, min(timestamp) AS first_dt, max(timestamp) AS last_dt
FROM s_access_logs WHERE threat_type <> 'normal'
GROUP BY ym, threat_type, ip_address""", "s_access_logs")
cte("g_risk_counters", """
SELECT user_id, count(access_id) AS acc_cnt,
       CAST(sum(CASE WHEN success = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fail_cnt,
       CAST(sum(CASE WHEN threat_type = 'brute_force' THEN 1 ELSE 0 END) AS BIGINT) AS bf_cnt,
       CAST(sum(CASE WHEN threat_type = 'bot' THEN 1 ELSE 0 END) AS BIGINT) AS bot_cnt,
       CAST(sum(CASE WHEN threat_type = 'fraud' THEN 1 ELSE 0 END) AS BIGINT) AS frd_cnt,
       count(DISTINCT ip_address) AS uniq_src, max(timestamp) AS last_ts
FROM s_access_logs GROUP BY user_id""", "s_access_logs")
cte("g_user_risk", """
SELECT r.*, u.name, u.age_group, u.prefecture
FROM (SELECT user_id AS usr_ref, acc_cnt, fail_cnt, bf_cnt, bot_cnt, frd_cnt, uniq_src, last_ts,
             rsk_val,
             CASE WHEN rsk_val >= 50 THEN 'critical' WHEN rsk_val >= 20 THEN 'high'
                  WHEN rsk_val >= 5 THEN 'medium' ELSE 'low' END AS rsk_cat
      FROM (SELECT *, fail_cnt * 1 + bf_cnt * 3 + bot_cnt * 5 + frd_cnt * 10 AS rsk_val
            FROM g_risk_counters)) r
LEFT JOIN s_users u ON r.usr_ref = u.user_id""", "g_risk_counters", "s_users")


def sql(final: str, *needed: str) -> str:
    """``WITH`` the needed CTEs (and their dependencies, in order) ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return final.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final.strip()}"


ORACLES: dict[str, str] = {}


def oracle(key: str, final: str, *needed: str) -> None:
    ORACLES[key] = sql(final, *needed)


for _t in ("users", "products", "orders", "order_items", "sessions", "access_logs"):
    oracle(f"bronze_{_t}", f"SELECT * FROM b_{_t}", f"b_{_t}")
    oracle(f"silver_{_t}", f"SELECT * FROM s_{_t}", f"s_{_t}")

for _m in ("monthly_sales", "rfm_base", "rfm_scores", "customer_rfm", "cart_abandonment",
           "access_summary", "threat_events", "risk_counters", "user_risk"):
    oracle(_m, f"SELECT * FROM g_{_m}", f"g_{_m}")

# ---------------------------------------------------------------- business questions
oracle("category_sales_trend", """
SELECT ym, category, sales_amount, order_count, prev_sales_amount,
       round((sales_amount - prev_sales_amount) / prev_sales_amount * 100, 1) AS change_pct
FROM (SELECT ym, category, sales_amount, order_count,
             CASE WHEN lag(ym) OVER w = strftime(CAST(ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
                  THEN lag(sales_amount) OVER w END AS prev_sales_amount
      FROM g_monthly_sales WINDOW w AS (PARTITION BY category ORDER BY ym))""", "g_monthly_sales")
oracle("churn_risk_by_age_group", """
SELECT age_group, churn_customers, CAST(rank() OVER (ORDER BY churn_customers DESC) AS INTEGER) AS rank_no
FROM (SELECT age_group, count(*) AS churn_customers FROM g_customer_rfm
      WHERE segment = '離脱リスク' GROUP BY age_group)""", "g_customer_rfm")
oracle("abandonment_by_category", """
SELECT *, CAST(rank() OVER (ORDER BY abandonment_rate DESC) AS INTEGER) AS rank_no
FROM (SELECT category, total_sessions, abandons,
             round(abandons / total_sessions * 100, 1) AS abandonment_rate
      FROM (SELECT category, CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
                   CAST(sum(abandons) AS BIGINT) AS abandons
            FROM g_cart_abandonment GROUP BY category))""", "g_cart_abandonment")
oracle("threat_trend_since", """
SELECT period, thr_cls, CAST(sum(evt_cnt) AS BIGINT) AS evt_cnt,
       CAST(sum(fail_cnt) AS BIGINT) AS fail_cnt, count(src_addr) AS src_cnt
FROM g_threat_events WHERE period >= '2025-10' GROUP BY period, thr_cls""", "g_threat_events")
oracle("top_risk_users", """
SELECT * FROM g_user_risk ORDER BY rsk_val DESC, usr_ref ASC LIMIT 10""", "g_user_risk")
oracle("late_night_suspicious", """
SELECT * EXCLUDE (tz_band) FROM g_access_summary
WHERE tz_band = '深夜帯' AND thr_cls <> 'normal'""", "g_access_summary")
oracle("silent_churn", """
SELECT user_id, recency_days, frequency, monetary, age_group, prefecture FROM g_customer_rfm
WHERE segment = '離脱リスク' AND recency_days > 90""", "g_customer_rfm")
oracle("gold_members", "SELECT * FROM g_customer_rfm WHERE segment = '優良顧客'", "g_customer_rfm")
oracle("top_categories_last_month", """
SELECT * FROM (SELECT ym, category, sales_amount, order_count,
                      CAST(row_number() OVER (ORDER BY sales_amount DESC, category ASC) AS INTEGER) AS rank_no
               FROM g_monthly_sales WHERE ym = (SELECT max(ym) FROM g_monthly_sales))
WHERE rank_no <= 3""", "g_monthly_sales")
oracle("top_categories_by_month", """
SELECT * FROM (SELECT ym, category, sales_amount,
                      CAST(row_number() OVER (PARTITION BY ym ORDER BY sales_amount DESC, category ASC) AS INTEGER) AS rank_no
               FROM g_monthly_sales)
WHERE rank_no <= 3""", "g_monthly_sales")
oracle("recent_threat_types", """
SELECT period, thr_cls, CAST(sum(evt_cnt) AS BIGINT) AS evt_cnt, count(src_addr) AS src_cnt,
       min(first_dt) AS first_dt, max(last_dt) AS last_dt
FROM g_threat_events WHERE period = (SELECT max(period) FROM g_threat_events)
GROUP BY period, thr_cls""", "g_threat_events")
cte("q_customer_360", """
SELECT u.user_id, u.name, u.age_group, u.prefecture, r.segment, r.recency_days,
       coalesce(r.frequency, 0) AS frequency, coalesce(r.monetary, 0) AS monetary,
       r.segment IS NOT NULL AS has_purchase,
       coalesce(k.rsk_val, 0) AS rsk_val, coalesce(k.rsk_cat, 'low') AS rsk_cat,
       coalesce(k.bot_cnt, 0) AS bot_cnt, coalesce(k.fail_cnt, 0) AS fail_cnt
FROM s_users u LEFT JOIN g_customer_rfm r ON u.user_id = r.user_id
LEFT JOIN g_user_risk k ON u.user_id = k.usr_ref""", "s_users", "g_customer_rfm", "g_user_risk")
oracle("customer_360", "SELECT * FROM q_customer_360", "q_customer_360")
oracle("response_decision", """
SELECT user_id, segment, rsk_val, rsk_cat, decision,
       CASE WHEN decision = 'compensate' THEN 5000 ELSE 0 END AS points
FROM (SELECT *, CASE WHEN rsk_val >= 50 THEN 'freeze' WHEN rsk_val >= 20 THEN 'review'
                     WHEN segment = '優良顧客' THEN 'compensate' ELSE 'standard' END AS decision
      FROM q_customer_360)""", "q_customer_360")
oracle("relief_candidates", """
SELECT user_id, recency_days, frequency, monetary, segment, age_group, prefecture
FROM g_customer_rfm r
WHERE segment = '優良顧客'
  AND EXISTS (SELECT 1 FROM s_orders o WHERE o.status = 'cancelled' AND o.user_id = r.user_id)
  AND NOT EXISTS (SELECT 1 FROM g_user_risk k WHERE k.rsk_val >= 20 AND k.usr_ref = r.user_id)""",
       "g_customer_rfm", "s_orders", "g_user_risk")
_MONTH = "substr({c}, 1, 4) || '年' || substr({c}, 6, 2) || '月'"
oracle("presented_sales", f"""
SELECT {_MONTH.format(c='ym')} AS month, category, format('{{:,}}', sales_amount) AS sales_yen,
       format('{{:,}}', order_count) AS orders, format('{{:,}}', unique_buyers) AS buyers,
       ym, sales_amount
FROM g_monthly_sales""", "g_monthly_sales")
oracle("presented_risk", """
SELECT usr_ref, name,
       CASE rsk_cat WHEN 'critical' THEN '危険' WHEN 'high' THEN '高' WHEN 'medium' THEN '中'
                    WHEN 'low' THEN '低' ELSE rsk_cat END AS risk_level,
       format('{:,}', rsk_val) AS risk_score, format('{:,}', acc_cnt) AS events, rsk_val
FROM g_user_risk""", "g_user_risk")
oracle("presented_threats", f"""
SELECT {_MONTH.format(c='period')} AS month,
       CASE thr_cls WHEN 'normal' THEN '通常' WHEN 'brute_force' THEN '総当たり攻撃'
                    WHEN 'bot' THEN 'BOTアクセス' WHEN 'fraud' THEN '不正購入試行'
                    ELSE thr_cls END AS threat,
       tz_band, format('{{:,}}', evt_cnt) AS events, format('{{:,}}', fail_cnt) AS failures,
       fail_pct, period, thr_cls
FROM g_access_summary""", "g_access_summary")

# ---------------------------------------------------------------- data quality
cte("f_items", """
SELECT item_id, order_id, product_id, quantity, unit_price,
       CASE WHEN order_id % 7 = 0 THEN subtotal ELSE unit_price * quantity END AS subtotal
FROM b_order_items""", "b_order_items")
cte("f_order_items", """
SELECT item_id, CASE WHEN order_id % 97 = 0 THEN -order_id ELSE order_id END AS order_id,
       CASE WHEN product_id % 97 = 0 THEN -product_id ELSE product_id END AS product_id,
       quantity, unit_price, subtotal FROM f_items""", "f_items")
cte("f_orders_once", """
SELECT o.order_id, user_id,
       CASE WHEN o.order_id % 89 = 0 THEN order_date || '?' ELSE order_date END AS order_date, status,
       CAST(CASE WHEN o.order_id % 7 = 0 THEN total_amount ELSE items END AS INTEGER) AS total_amount,
       channel, 'cat' || CAST(o.order_id % 8 AS VARCHAR) AS category
FROM b_orders o LEFT JOIN (SELECT order_id, sum(subtotal) AS items FROM f_items GROUP BY order_id) s
  ON o.order_id = s.order_id""", "b_orders", "f_items")
cte("f_orders", """
SELECT * FROM f_orders_once UNION ALL SELECT * FROM f_orders_once WHERE order_id % 251 = 0""",
    "f_orders_once")
cte("f_products", """
SELECT * REPLACE ('cat' || CAST(product_id % 8 AS VARCHAR) AS category) FROM b_products""", "b_products")
cte("f_users", "SELECT * FROM b_users UNION ALL SELECT * FROM b_users WHERE user_id % 251 = 0", "b_users")
cte("f_sessions", """
SELECT * REPLACE (CASE WHEN session_id % 89 = 0 THEN session_date || '?' ELSE session_date END
                  AS session_date) FROM b_sessions""", "b_sessions")
cte("f_access_logs", """
SELECT * REPLACE (CASE WHEN access_id % 89 = 0 THEN timestamp || '?' ELSE timestamp END AS timestamp)
FROM b_access_logs""", "b_access_logs")
oracle("dq_item_subtotal", """
SELECT item_id, order_id, quantity, unit_price, subtotal,
       CAST(unit_price AS BIGINT) * quantity AS expected_subtotal
FROM f_order_items WHERE subtotal IS DISTINCT FROM CAST(unit_price AS BIGINT) * quantity""",
       "f_order_items")
oracle("dq_order_total", """
SELECT * FROM (
  SELECT coalesce(o.order_id, i.order_id) AS order_id, o.total_amount, i.item_total,
         CASE WHEN o.total_amount IS NULL AND i.item_total IS NOT NULL THEN 'no_order'
              WHEN i.item_total IS NULL THEN 'no_items'
              WHEN o.total_amount <> i.item_total THEN 'mismatch' END AS issue
  FROM f_orders o
  FULL OUTER JOIN (SELECT order_id, CAST(sum(subtotal) AS BIGINT) AS item_total
                   FROM f_order_items GROUP BY order_id) i ON o.order_id = i.order_id)
WHERE issue IS NOT NULL""", "f_orders", "f_order_items")
oracle("dq_orphans", """
SELECT item_id, order_id, product_id, 'unknown_order' AS issue FROM f_order_items i
WHERE NOT EXISTS (SELECT 1 FROM f_orders o WHERE o.order_id = i.order_id)
UNION ALL
SELECT item_id, order_id, product_id, 'unknown_product' AS issue FROM f_order_items i
WHERE NOT EXISTS (SELECT 1 FROM f_products p WHERE p.product_id = i.product_id)""",
       "f_order_items", "f_orders", "f_products")
oracle("dq_category_match", """
SELECT i.item_id, i.order_id, i.product_id, o.category AS order_category,
       p.category AS product_category
FROM f_order_items i JOIN (SELECT DISTINCT order_id, category FROM f_orders) o
  ON i.order_id = o.order_id
JOIN f_products p ON i.product_id = p.product_id
WHERE o.category IS DISTINCT FROM p.category""", "f_order_items", "f_orders", "f_products")
oracle("dq_duplicate_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS n "
    f"FROM f_{t} GROUP BY {k} HAVING count(*) > 1"
    for t, k in (("users", "user_id"), ("products", "product_id"), ("orders", "order_id"),
                 ("order_items", "item_id"), ("sessions", "session_id"),
                 ("access_logs", "access_id"))),
       "f_users", "f_products", "f_orders", "f_order_items", "f_sessions", "f_access_logs")
_DOM = (("orders", "status", "'completed', 'cancelled', 'returned'"),
        ("orders", "channel", "'web', 'mobile', 'app'"),
        ("sessions", "event_type", "'view', 'add_to_cart', 'purchase', 'abandon'"),
        ("access_logs", "event_type", "'login', 'page_view', 'add_to_cart', 'purchase_attempt'"),
        ("access_logs", "threat_type", "'normal', 'brute_force', 'bot', 'fraud'"))
oracle("dq_domains", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS n, "
    f"coalesce({c} IN ({vals}), false) AS in_domain FROM b_{t} GROUP BY {c}"
    for t, c, vals in _DOM), "b_orders", "b_sessions", "b_access_logs")
oracle("dq_bot_orders", """
SELECT order_id, user_id, status, order_date FROM s_orders o
WHERE EXISTS (SELECT 1 FROM s_access_logs a WHERE a.threat_type = 'bot' AND a.user_id = o.user_id)""",
       "s_orders", "s_access_logs")
oracle("dq_rejects", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, '{c}' AS column_name, "
    f"{c} AS raw_value FROM f_{t} WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {typ}) IS NULL"
    for t, k, c, typ in (("users", "user_id", "registration_date", "DATE"),
                         ("orders", "order_id", "order_date", "DATE"),
                         ("sessions", "session_id", "session_date", "DATE"),
                         ("access_logs", "access_id", "timestamp", "TIMESTAMP"))),
       "f_users", "f_orders", "f_sessions", "f_access_logs")

# ---------------------------------------------------------------- sinks, pipeline
oracle("table_roundtrip", "SELECT * FROM g_user_risk", "g_user_risk")
oracle("schema_evolution_overwrite", "SELECT * FROM g_monthly_sales", "g_monthly_sales")
_LAYERS = [("bronze", t, f"b_{t}") for t in ("users", "products", "orders", "order_items",
                                               "sessions", "access_logs")]
_LAYERS += [("silver", t, f"s_{t}") for t in ("users", "products", "orders", "order_items",
                                                "sessions", "access_logs")]
_LAYERS += [("gold", t, f"g_{t}") for t in ("monthly_sales", "customer_rfm", "cart_abandonment",
                                              "access_summary", "threat_events", "user_risk")]
oracle("medallion_row_counts", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {c}"
    for layer, t, c in _LAYERS), *[c for _, _, c in _LAYERS])

# ---------------------------------------------------------------- retrieval
cte("r_passages", """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, passage
FROM (SELECT doc_id, unnest(parts) AS passage, generate_subscripts(parts, 1) - 1 AS pos
      FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
WHERE trim(passage) <> ''""")
cte("r_post", r"""
SELECT p.doc_id, p.pos, p.term, p.tf, l.dl FROM
  (SELECT doc_id, pos, term, count(*) AS tf
   FROM (SELECT doc_id, pos, unnest(regexp_split_to_array(lower(passage), '[^\p{L}\p{N}]+')) AS term
         FROM r_passages)
   WHERE term <> '' GROUP BY doc_id, pos, term) p
JOIN (SELECT doc_id, pos, CAST(sum(tf) AS BIGINT) AS dl
      FROM (SELECT doc_id, pos, unnest(regexp_split_to_array(lower(passage), '[^\p{L}\p{N}]+')) AS term,
                   1 AS tf FROM r_passages)
      WHERE term <> '' GROUP BY doc_id, pos) l
ON p.doc_id = l.doc_id AND p.pos = l.pos""", "r_passages")
cte("r_stats", "SELECT count(*) AS n, avg(dl) AS avgdl FROM (SELECT DISTINCT doc_id, pos, dl FROM r_post)",
    "r_post")
cte("r_scores", r"""
SELECT qid, doc_id, pos,
       sum(CAST(ln(1 + (CAST(n - df AS DOUBLE) + 0.5) / (CAST(df AS DOUBLE) + 0.5))
                * ((tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS DECIMAL(20,12))) AS s
FROM (SELECT DISTINCT item_id AS qid,
             unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM benchmark) q
JOIN r_post USING (term)
JOIN (SELECT term, count(*) AS df FROM r_post GROUP BY term) d USING (term)
CROSS JOIN r_stats
WHERE term <> ''
GROUP BY qid, doc_id, pos""", "r_post", "r_stats")
oracle("passages", "SELECT * FROM r_passages", "r_passages")
oracle("lexical_topk", """
SELECT t.item_id, t.rank_no, t.doc_id, t.pos, t.score, d.source, p.passage
FROM (SELECT qid AS item_id, rank_no, doc_id, pos, round(CAST(s AS DOUBLE), 6) AS score
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY s DESC, doc_id, pos) AS INTEGER) AS rank_no
            FROM r_scores) WHERE rank_no <= 5) t
JOIN documents d ON t.doc_id = d.doc_id
JOIN r_passages p ON t.doc_id = p.doc_id AND t.pos = p.pos""", "r_scores", "r_passages")
oracle("vector_topk", """
SELECT label, rank_no, vec_id, score FROM (
  SELECT c.label, e.vec_id,
         round(list_dot_product(c.cent, CAST(e.embedding AS DOUBLE[]))
               / (sqrt(list_dot_product(c.cent, c.cent))
                  * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))), 6) AS score,
         CAST(row_number() OVER (PARTITION BY c.label ORDER BY
             list_dot_product(c.cent, CAST(e.embedding AS DOUBLE[]))
               / (sqrt(list_dot_product(c.cent, c.cent))
                  * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))) DESC,
             e.vec_id) AS INTEGER) AS rank_no
  FROM (SELECT label, list(m ORDER BY i) AS cent
        FROM (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m
              FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i
                    FROM embeddings) GROUP BY label, i)
        GROUP BY label) c
  CROSS JOIN embeddings e)
WHERE rank_no <= 10""")

ORACLES["vector_index_topk"] = ORACLES["vector_topk"]
_LEVEL = """
SELECT '{level}' AS level, {period} AS period, {threat} AS thr_cls,
       count(DISTINCT ip_address) AS uniq_src, count(DISTINCT user_id) AS uniq_usr
FROM s_access_logs GROUP BY {keys}"""
_QUARTER = "substr(ym, 1, 4) || '-Q' || CAST((CAST(substr(ym, 6, 2) AS INTEGER) + 2) // 3 AS VARCHAR)"
oracle("distinct_rollups", " UNION ALL ".join(
    _LEVEL.format(level=level, period=period, threat=threat, keys=keys) for level, period, threat, keys in (
        ("month and threat", "ym", "threat_type", "ym, threat_type"),
        ("quarter", _QUARTER, "CAST(NULL AS VARCHAR)", _QUARTER),
        ("threat", "CAST(NULL AS VARCHAR)", "threat_type", "threat_type"),
        ("all", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "true"))), "s_access_logs")

# ---------------------------------------------------------------- evaluation statistics
cte("v_spans", """
SELECT conv_id AS trace_id, turn AS span_id, role AS agent, turn * 1000 AS start_ms,
       CAST(turn * 1000 + length(text) AS BIGINT) AS end_ms
FROM conversations""")
cte("v_verdicts", """
SELECT d.source AS run_id, d.doc_id AS trace_id, j.judge,
       CASE WHEN j.judge = 'quality' THEN (CASE l.quality WHEN 1 THEN 'pass' WHEN 0 THEN 'fail' END)
            ELSE (CASE l.toxic WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' END) END AS verdict
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
CROSS JOIN (VALUES ('quality'), ('safety')) j(judge)""")
cte("v_slowest", """
SELECT trace_id, span_id, agent FROM (
  SELECT *, row_number() OVER (PARTITION BY trace_id
                               ORDER BY end_ms - start_ms DESC, span_id ASC) AS rn
  FROM v_spans) WHERE rn = 1""", "v_spans")
oracle("pass_rate", """
SELECT *, round(passed / (passed + failed) * 100, 1) AS pass_pct FROM (
  SELECT judge, count(*) AS n,
         CAST(sum(CASE WHEN verdict = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS passed,
         CAST(sum(CASE WHEN verdict = 'fail' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
         CAST(sum(CASE WHEN verdict IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS empty
  FROM v_verdicts GROUP BY judge)""", "v_verdicts")
cte("v_run_pass", """
SELECT *, round(passed / (passed + failed) * 100, 1) AS pass_pct FROM (
  SELECT run_id, judge,
         CAST(sum(CASE WHEN verdict = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS passed,
         CAST(sum(CASE WHEN verdict = 'fail' THEN 1 ELSE 0 END) AS BIGINT) AS failed
  FROM v_verdicts GROUP BY run_id, judge)""", "v_verdicts")
oracle("run_comparison", """
SELECT p.run_id, p.judge, p.passed, p.failed, p.pass_pct, b.pass_pct AS baseline_pct,
       round(p.pass_pct - b.pass_pct, 1) AS delta_pct
FROM v_run_pass p LEFT JOIN (SELECT judge, pass_pct FROM v_run_pass
                             WHERE run_id = (SELECT min(run_id) FROM v_verdicts)) b
ON p.judge = b.judge""", "v_run_pass", "v_verdicts")
oracle("latency_profile", """
SELECT a.agent, a.calls, a.p50_ms, a.p95_ms, a.max_ms,
       coalesce(s.slowest_traces, 0) AS slowest_traces,
       round(coalesce(s.slowest_traces, 0) / (SELECT count(DISTINCT trace_id) FROM v_spans) * 100, 1)
         AS slowest_share_pct
FROM (SELECT agent, count(*) AS calls,
             round(quantile_cont(end_ms - start_ms, 0.5), 6) AS p50_ms,
             round(quantile_cont(end_ms - start_ms, 0.95), 6) AS p95_ms,
             max(end_ms - start_ms) AS max_ms
      FROM v_spans GROUP BY agent) a
LEFT JOIN (SELECT agent, count(*) AS slowest_traces FROM v_slowest GROUP BY agent) s
ON a.agent = s.agent""", "v_spans", "v_slowest")
oracle("trace_call_profile", """
SELECT p.*, p.span_id = s.span_id AS is_slowest FROM (
  SELECT trace_id, span_id, agent, start_ms, end_ms, end_ms - start_ms AS duration_ms,
         CAST(row_number() OVER w AS INTEGER) AS seq,
         coalesce(start_ms < max(end_ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                  false) AS overlaps_prior
  FROM v_spans WINDOW w AS (PARTITION BY trace_id ORDER BY start_ms, span_id)) p
LEFT JOIN v_slowest s ON p.trace_id = s.trace_id""", "v_spans", "v_slowest")
for _key in ("trace_id", "agent"):
    cte(f"v_depths_{_key}", f"""
SELECT {_key}, depth, CAST(sum(t_end - t) AS BIGINT) AS ms, min(t) AS first_at FROM (
  SELECT {_key}, t, CAST(sum(step) OVER w AS BIGINT) AS depth, lead(t) OVER w AS t_end FROM (
    SELECT {_key}, t, sum(step) AS step FROM (
      SELECT {_key}, CAST(start_ms AS BIGINT) AS t, 1 AS step FROM v_spans WHERE start_ms < end_ms
      UNION ALL
      SELECT {_key}, end_ms AS t, -1 AS step FROM v_spans WHERE start_ms < end_ms)
    WHERE {_key} IS NOT NULL GROUP BY {_key}, t HAVING sum(step) <> 0)
  WINDOW w AS (PARTITION BY {_key} ORDER BY t))
WHERE t_end IS NOT NULL GROUP BY {_key}, depth""", "v_spans")
oracle("trace_depth_time", "SELECT * FROM v_depths_trace_id", "v_depths_trace_id")
oracle("agent_depth_time", "SELECT * FROM v_depths_agent", "v_depths_agent")
oracle("trace_parallelism", """
SELECT trace_id, max(depth) AS peak, arg_max(first_at, depth) AS peak_at,
       CAST(coalesce(sum(ms) FILTER (WHERE depth > 0), 0) AS BIGINT) AS busy_ms,
       CAST(coalesce(sum(ms) FILTER (WHERE depth > 1), 0) AS BIGINT) AS parallel_ms,
       CAST(coalesce(sum(ms) FILTER (WHERE depth = 0), 0) AS BIGINT) AS idle_ms
FROM v_depths_trace_id GROUP BY trace_id""", "v_depths_trace_id")
oracle("clustered_access_logs", "SELECT * FROM s_access_logs", "s_access_logs")
oracle("evaluation_dataset", """
SELECT d.doc_id AS trace_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id IN (SELECT doc_id FROM (
    SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY s DESC, doc_id, pos) AS rn
    FROM r_scores) WHERE rn <= 5)""", "r_scores")
oracle("csv_roundtrip", "SELECT * FROM b_access_logs", "b_access_logs")
oracle("csv_range_scan", r"""
SELECT * REPLACE (CASE WHEN order_id % 5 = 0
                       THEN category || chr(10) || '"no. ' || CAST(order_id AS VARCHAR) || '",' || chr(10) || chr(10)
                       ELSE category END AS category)
FROM b_orders""", "b_orders")
for _m in ("monthly_sales", "customer_rfm", "cart_abandonment", "access_summary", "threat_events",
           "user_risk"):
    ORACLES[f"refreshed_{_m}"] = ORACLES[_m]
ORACLES["access_summary_stream"] = ORACLES["access_summary"]
ORACLES["threat_events_stream"] = ORACLES["threat_events"]
ORACLES["pass_rate_stream"] = ORACLES["pass_rate"]
ORACLES["customer_360_colocated"] = ORACLES["customer_360"]
oracle("presented_threat_events", f"""
SELECT {_MONTH.format(c='period')} AS month,
       CASE thr_cls WHEN 'normal' THEN '通常' WHEN 'brute_force' THEN '総当たり攻撃'
                    WHEN 'bot' THEN 'BOTアクセス' WHEN 'fraud' THEN '不正購入試行'
                    ELSE thr_cls END AS threat,
       src_addr, format('{{:,}}', evt_cnt) AS events, format('{{:,}}', tgt_usr) AS targets,
       period, evt_cnt, thr_cls
FROM g_threat_events ORDER BY period, evt_cnt DESC, thr_cls, src_addr""", "g_threat_events")
