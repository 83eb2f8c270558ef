"""Searched-CASE buckets of the pipeline, as Column expressions.

Fixed values: the labels and thresholds below must equal the reference's.
A NULL input falls through to the ``otherwise`` branch, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age groups (upper bounds are exclusive), last one is the default.
AGE_GROUPS = ((30, "10-20代"), (40, "30代"), (50, "40代"))
AGE_GROUP_DEFAULT = "50代以上"

# Time bands by inclusive hour range; default covers 18-1 and NULL.
TIME_BANDS = ((2, 5, "深夜帯"), (6, 11, "午前"), (12, 17, "午後"))
TIME_BAND_DEFAULT = "夜間"

# RFM scores.  Recency: days <= bound; frequency, monetary: value >= bound.
RECENCY_SCORES = ((30, 5), (90, 4), (180, 3), (365, 2))
FREQUENCY_SCORES = ((10, 5), (6, 4), (3, 3), (2, 2))
MONETARY_SCORES = ((100000, 5), (50000, 4), (20000, 3), (10000, 2))
SCORE_DEFAULT = 1

# Segments by rfm_total >= bound.
SEGMENTS = ((13, "優良顧客"), (10, "成長顧客"), (7, "休眠予備軍"))
SEGMENT_DEFAULT = "離脱リスク"
LOYAL, CHURN_RISK = "優良顧客", "離脱リスク"

# Risk score weights and levels by rsk_val >= bound.
RISK_WEIGHTS = {"fail_cnt": 1, "bf_cnt": 3, "bot_cnt": 5, "frd_cnt": 10}
RISK_LEVELS = ((50, "critical"), (20, "high"), (5, "medium"))
RISK_DEFAULT = "low"

LATE_NIGHT = "深夜帯"


def _chain(pairs, test, default) -> Column:
    out = None
    for bound, label in pairs:
        cond = test(bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def age_group(age: Column) -> Column:
    return _chain(AGE_GROUPS, lambda b: age < b, AGE_GROUP_DEFAULT)


def time_band(hour: Column) -> Column:
    out = None
    for lo, hi, label in TIME_BANDS:
        cond = hour.between(lo, hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(TIME_BAND_DEFAULT)


def recency_score(days: Column) -> Column:
    return _chain(RECENCY_SCORES, lambda b: days <= b, SCORE_DEFAULT)


def frequency_score(n: Column) -> Column:
    return _chain(FREQUENCY_SCORES, lambda b: n >= b, SCORE_DEFAULT)


def monetary_score(m: Column) -> Column:
    return _chain(MONETARY_SCORES, lambda b: m >= b, SCORE_DEFAULT)


def segment(total: Column) -> Column:
    return _chain(SEGMENTS, lambda b: total >= b, SEGMENT_DEFAULT)


def risk_value() -> Column:
    out = None
    for c, w in RISK_WEIGHTS.items():
        term = F.col(c) * w
        out = term if out is None else out + term
    return out


def risk_level(v: Column) -> Column:
    return _chain(RISK_LEVELS, lambda b: v >= b, RISK_DEFAULT)


def count_when(cond: Column) -> Column:
    """sum(case when cond then 1 else 0) -- bigint, NULL condition counts 0."""
    return F.sum(F.when(cond, 1).otherwise(0))


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(num / den * 100, digits); NULL when den is 0 instead of an error."""
    return F.round(F.try_divide(num, den) * 100, digits)
