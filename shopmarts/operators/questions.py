"""Business questions over the gold marts (Q1-Q14).

Inputs are marts, i.e. already aggregated: monthly_sales and cart_abandonment
have one row per (month, category), access_summary one per (month, threat,
band); customer_rfm and user_risk one row per user.  Windows are only used over
the small month x category marts, or with a row limit that Spark pushes below
the shuffle (WindowGroupLimit), so no task ever holds an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.functions import buckets as B

# Response policy (risk >= 50 freeze, 20-49 review, loyal -> 5,000 points).
FREEZE_AT, REVIEW_AT = 50, 20
COMPENSATION_POINTS = 5000


def _month_start(ym):
    return F.to_date(F.concat(ym, F.lit("-01")))


def category_sales_trend(monthly_sales: DataFrame, category: str | None = None) -> DataFrame:
    """Q1: sales by month for one category (all when None), with the previous
    calendar month's sales and the change in percent.  Months are sparse, so the
    lagged row only counts when it is exactly the preceding month."""
    ms = monthly_sales if category is None else monthly_sales.filter(F.col("category") == category)
    w = Window.partitionBy("category").orderBy("ym")
    prev_ym, prev_amt = F.lag("ym").over(w), F.lag("sales_amount").over(w)
    expected = F.date_format(F.add_months(_month_start(F.col("ym")), -1), "yyyy-MM")
    out = ms.select("ym", "category", "sales_amount", "order_count",
                    F.when(prev_ym == expected, prev_amt).alias("prev_sales_amount"))
    return out.withColumn(
        "change_pct",
        F.round(F.try_divide(F.col("sales_amount") - F.col("prev_sales_amount"),
                             F.col("prev_sales_amount")) * 100, 1))


def churn_risk_by_age_group(customer_rfm: DataFrame) -> DataFrame:
    """Q2: churn-risk customers per age group, ranked.  The rank is a global
    window over the aggregate, which has at most 4 rows (one per age group)."""
    agg = (customer_rfm.filter(F.col("segment") == B.CHURN_RISK)
           .groupBy("age_group").agg(F.count(F.lit(1)).alias("churn_customers")))
    return agg.withColumn("rank_no", F.rank().over(Window.orderBy(F.desc("churn_customers"))))


def abandonment_by_category(cart_abandonment: DataFrame) -> DataFrame:
    """Q3: abandonment rate per category over all months: sum(abandons) /
    sum(total_sessions), never a mean of monthly rates; ranked.  The rank is a
    global window over one row per category (the category dimension)."""
    agg = (cart_abandonment.groupBy("category")
           .agg(F.sum("total_sessions").alias("total_sessions"),
                F.sum("abandons").alias("abandons"))
           .withColumn("abandonment_rate", B.pct(F.col("abandons"), F.col("total_sessions"))))
    return agg.withColumn("rank_no", F.rank().over(Window.orderBy(F.desc("abandonment_rate"))))


def threat_trend_since(threat_events: DataFrame, since: str = "2025-10") -> DataFrame:
    """Q4: threat events per month and kind from ``since`` (yyyy-MM) on."""
    return (threat_events.filter(F.col("period") >= since)
            .groupBy("period", "thr_cls")
            .agg(F.sum("evt_cnt").alias("evt_cnt"), F.sum("fail_cnt").alias("fail_cnt"),
                 F.count("src_addr").alias("src_cnt")))


def top_risk_users(user_risk: DataFrame, k: int = 10) -> DataFrame:
    """Q5: the k riskiest users (ties broken by user id); a distributed top-k."""
    return user_risk.orderBy(F.desc("rsk_val"), F.asc("usr_ref")).limit(k)


def late_night_suspicious(access_summary: DataFrame) -> DataFrame:
    """Q6: non-normal access in the late-night band (one mart row per month x kind)."""
    return (access_summary.filter((F.col("tz_band") == B.LATE_NIGHT)
                                  & (F.col("thr_cls") != "normal"))
            .drop("tz_band"))


def silent_churn(customer_rfm: DataFrame, days: int = 90) -> DataFrame:
    """Q7: churn-risk customers with no purchase for more than ``days`` days."""
    return (customer_rfm.filter((F.col("segment") == B.CHURN_RISK)
                                & (F.col("recency_days") > days))
            .select("user_id", "recency_days", "frequency", "monetary", "age_group",
                    "prefecture"))


def gold_members(customer_rfm: DataFrame) -> DataFrame:
    """Q8: 'gold members' are the loyal segment."""
    return customer_rfm.filter(F.col("segment") == B.LOYAL)


def top_categories_last_month(monthly_sales: DataFrame, k: int = 3) -> DataFrame:
    """Q9: top-k categories by sales in the latest month (scalar subquery)."""
    last = monthly_sales.agg(F.max("ym")).scalar()
    month = monthly_sales.filter(F.col("ym") == last)
    w = Window.orderBy(F.desc("sales_amount"), F.asc("category"))
    return (month.select("ym", "category", "sales_amount", "order_count",
                         F.row_number().over(w).alias("rank_no"))
            .filter(F.col("rank_no") <= k))


def top_categories_by_month(monthly_sales: DataFrame, k: int = 3) -> DataFrame:
    """Q9, every month: per-month top-k (limit pushed below the shuffle)."""
    w = Window.partitionBy("ym").orderBy(F.desc("sales_amount"), F.asc("category"))
    return (monthly_sales.select("ym", "category", "sales_amount",
                                 F.row_number().over(w).alias("rank_no"))
            .filter(F.col("rank_no") <= k))


def recent_threat_types(threat_events: DataFrame) -> DataFrame:
    """Q10: threat kinds seen in the latest month, with events and sources."""
    last = threat_events.agg(F.max("period")).scalar()
    return (threat_events.filter(F.col("period") == last)
            .groupBy("period", "thr_cls")
            .agg(F.sum("evt_cnt").alias("evt_cnt"), F.count("src_addr").alias("src_cnt"),
                 F.min("first_dt").alias("first_dt"), F.max("last_dt").alias("last_dt")))


def customer_360(users: DataFrame, customer_rfm: DataFrame, user_risk: DataFrame) -> DataFrame:
    """Q11: every user with RFM segment and risk.  All three inputs are keyed by
    user id, so both left joins reuse one hash partitioning of user_id.
    No RFM row means no completed purchase; no risk row means score 0, low.

    Since users drive the left joins, the RFM and risk inputs may be given
    without their own user-dimension join (``rfm_scores``, ``risk_scores``):
    same rows, one scan of the dimension instead of three."""
    rfm = customer_rfm.select("user_id", "segment", "recency_days", "frequency", "monetary")
    risk = user_risk.select(F.col("usr_ref").alias("user_id"), "rsk_val", "rsk_cat", "bot_cnt",
                            "fail_cnt")
    return (users.select("user_id", "name", "age_group", "prefecture")
            .join(rfm, "user_id", "left")
            .join(risk, "user_id", "left")
            .select("user_id", "name", "age_group", "prefecture", "segment", "recency_days",
                    F.coalesce("frequency", F.lit(0).cast("long")).alias("frequency"),
                    F.coalesce("monetary", F.lit(0).cast("long")).alias("monetary"),
                    F.col("segment").isNotNull().alias("has_purchase"),
                    F.coalesce("rsk_val", F.lit(0).cast("long")).alias("rsk_val"),
                    F.coalesce("rsk_cat", F.lit(B.RISK_DEFAULT)).alias("rsk_cat"),
                    F.coalesce("bot_cnt", F.lit(0).cast("long")).alias("bot_cnt"),
                    F.coalesce("fail_cnt", F.lit(0).cast("long")).alias("fail_cnt")))


def response_decision(c360: DataFrame, freeze_at: int = FREEZE_AT,
                      review_at: int = REVIEW_AT) -> DataFrame:
    """Q12: compensate / review / freeze, by the numeric account policy."""
    r = F.col("rsk_val")
    decision = (F.when(r >= freeze_at, "freeze").when(r >= review_at, "review")
                .when(F.col("segment") == B.LOYAL, "compensate").otherwise("standard"))
    return c360.select("user_id", "segment", "rsk_val", "rsk_cat", decision.alias("decision"),
                       F.when(decision == "compensate", COMPENSATION_POINTS).otherwise(0)
                        .alias("points"))


def relief_candidates(customer_rfm: DataFrame, orders: DataFrame, user_risk: DataFrame,
                      review_at: int = REVIEW_AT) -> DataFrame:
    """Q13: loyal customers with a cancelled order and no fraud suspicion.

    The cancelled-order side is deduplicated first (partial aggregation map-side),
    so a user with a huge number of cancellations cannot skew the semi join."""
    cancelled = orders.filter(F.col("status") == "cancelled").select("user_id").distinct()
    risky = user_risk.filter(F.col("rsk_val") >= review_at).select(
        F.col("usr_ref").alias("user_id"))
    return (customer_rfm.filter(F.col("segment") == B.LOYAL)
            .join(cancelled, "user_id", "left_semi")
            .join(risky, "user_id", "left_anti")
            .select("user_id", "recency_days", "frequency", "monetary", "segment",
                    "age_group", "prefecture"))
