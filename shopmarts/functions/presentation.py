"""Presentation layer (Q14): thousands separators, yyyy年MM月 labels, and
Japanese labels for threat kinds and risk levels.  Sorting is applied last,
with full tie-breaks, only when a caller wants an ordered report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Display labels for threat kinds and risk levels.
THREAT_LABELS = {"normal": "通常", "brute_force": "総当たり攻撃", "bot": "BOTアクセス",
                 "fraud": "不正購入試行"}
RISK_LABELS = {"critical": "危険", "high": "高", "medium": "中", "low": "低"}


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def month_label(ym: Column) -> Column:
    """'2024-03' -> '2024年03月'."""
    return F.concat(F.substring(ym, 1, 4), F.lit("年"), F.substring(ym, 6, 2), F.lit("月"))


def label(c: Column, mapping: dict) -> Column:
    """Code -> label; unknown codes are kept as they are."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(c)


def presented_sales(monthly_sales: DataFrame) -> DataFrame:
    """Sales report, ascending by month and category (O1)."""
    return presentation_order(monthly_sales.select(
        month_label(F.col("ym")).alias("month"), "category",
        thousands(F.col("sales_amount")).alias("sales_yen"),
        thousands(F.col("order_count")).alias("orders"),
        thousands(F.col("unique_buyers")).alias("buyers"),
        "ym", "sales_amount"), "ym", "category")


def presented_risk(user_risk: DataFrame) -> DataFrame:
    """Risk report, riskiest first (O3), ties by user id."""
    return presentation_order(user_risk.select(
        "usr_ref", "name", label(F.col("rsk_cat"), RISK_LABELS).alias("risk_level"),
        thousands(F.col("rsk_val")).alias("risk_score"),
        thousands(F.col("acc_cnt")).alias("events"), "rsk_val"),
        F.desc("rsk_val"), F.asc_nulls_last("usr_ref"))


def presented_threats(access_summary: DataFrame) -> DataFrame:
    """Access report by month and threat kind (O1), then band."""
    return presentation_order(access_summary.select(
        month_label(F.col("period")).alias("month"),
        label(F.col("thr_cls"), THREAT_LABELS).alias("threat"), "tz_band",
        thousands(F.col("evt_cnt")).alias("events"),
        thousands(F.col("fail_cnt")).alias("failures"), "fail_pct", "period", "thr_cls"),
        "period", "thr_cls", "tz_band")


def presented_threat_events(threat_events: DataFrame) -> DataFrame:
    """Threat report: months ascending, busiest sources first (O2)."""
    return presentation_order(threat_events.select(
        month_label(F.col("period")).alias("month"),
        label(F.col("thr_cls"), THREAT_LABELS).alias("threat"), "src_addr",
        thousands(F.col("evt_cnt")).alias("events"),
        thousands(F.col("tgt_usr")).alias("targets"), "period", "evt_cnt", "thr_cls"),
        "period", F.desc("evt_cnt"), "thr_cls", "src_addr")


def presentation_order(df: DataFrame, *keys) -> DataFrame:
    """Global sort for a report (a range exchange); keys must make it total."""
    return df.orderBy(*keys)
