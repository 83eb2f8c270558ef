"""The command line: pipeline into a database, then questions over the written marts
give the same rows as the registered queries over the driver tables."""

import uuid

import pytest

from __spark_entry__ import queries
from shopmarts.__main__ import QUESTIONS, ask, main
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def database(spark):
    db = f"cli_{uuid.uuid4().hex[:8]}"
    assert main(["pipeline", "--src", SF_SMALL, "--database", db, "--driver"]) == 0
    return db


@pytest.mark.parametrize("question", ["top_risk_users", "customer_360", "response_decision",
                                      "relief_candidates", "category_sales_trend",
                                      "recent_threat_types", "presented_threats",
                                      "churn_risk_by_age_group", "silent_churn"])
def test_written_marts_answer_like_lazy_plans(spark, database, question):
    got = sorted(map(repr, ask(spark, database, question).collect()))
    want = sorted(map(repr, queries()[question](spark, SF_SMALL).collect()))
    assert got == want


def test_parameters_and_commands(spark, database, capsys):
    one = ask(spark, database, "response_decision", user_id="42").collect()
    assert len(one) == 1 and one[0].user_id == 42
    hits = ask(spark, database, "catalog_search", term="バスケット落ち").collect()
    assert [(r.table_name, r.column_name) for r in hits] == [("gold_cart_abandonment",
                                                              "abandonment_rate")]
    assert main(["list"]) == 0
    assert "top_risk_users" in capsys.readouterr().out
    assert set(QUESTIONS) >= {"top_risk_users", "customer_360", "catalog_search"}
