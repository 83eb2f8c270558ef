"""Cross-query consistency on the driver data (sf0.01): answers agree with each other."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    qs = queries()
    return lambda name: qs[name](spark, SF)


def test_relief_candidates_are_unsuspicious_gold_members(q):
    relief = {r.user_id for r in q("relief_candidates").collect()}
    gold = {r.user_id for r in q("gold_members").collect()}
    risky = {r.usr_ref for r in q("user_risk").filter(F.col("rsk_val") >= 20).collect()}
    assert relief and relief <= gold and not (relief & risky)


def test_decisions_follow_the_policy(q):
    for r in q("response_decision").collect():
        if r.rsk_val >= 50:
            assert r.decision == "freeze"
        elif r.rsk_val >= 20:
            assert r.decision == "review"
        elif r.segment == "優良顧客":
            assert r.decision == "compensate" and r.points == 5000
        else:
            assert r.decision == "standard" and r.points == 0


def test_top_risk_users_are_the_top_of_the_mart(q):
    top = [(r.rsk_val, r.usr_ref) for r in q("top_risk_users").collect()]
    allr = sorted(((r.rsk_val, r.usr_ref) for r in q("user_risk").collect()),
                  key=lambda t: (-t[0], t[1]))
    assert sorted(top, key=lambda t: (-t[0], t[1])) == allr[:10]


def test_churn_counts_add_up(q):
    by_age = sum(r.churn_customers for r in q("churn_risk_by_age_group").collect())
    rfm = q("customer_rfm").filter(F.col("segment") == "離脱リスク").count()
    assert by_age == rfm
    assert q("silent_churn").count() <= rfm
