"""Marts refreshed by month equal a full rebuild and rewrite only their months."""

import os
import random
from collections import Counter
from urllib.parse import urlparse

import pytest

from shopmarts.operators import marts, silver
from shopmarts.plans import refresh as R
from shopmarts.sources.tables import Lazy
from tests.fixtures import access, order, raw_frames, user


def rows(seed=1, n=240):
    rng = random.Random(seed)
    month = lambda: f"2025-{rng.randint(1, 6):02d}"
    return {
        "orders": [order(i, rng.choice([None, 1, 2, 3, 4]), f"{month()}-1{i % 10}",
                         status=rng.choice(["completed", "cancelled"]), category=rng.choice("ab"))
                   for i in range(n)],
        "sessions": [(i, 1, 1, rng.choice("ab"), rng.choice(["view", "abandon", "purchase"]),
                      f"{month()}-03") for i in range(n)],
        "access_logs": [access(i, rng.choice([None, 1, 2, 3]), ts=f"{month()}-07 {i % 24:02d}:00:00",
                               ip=rng.choice([None, "10.0.0.1", "10.0.0.2", "10.0.0.3"]),
                               success=rng.choice([0, 1]), threat=rng.choice(["normal", "bot", "fraud"]))
                        for i in range(n)],
    }


USERS = [user(1), user(2, age=25), user(3, age=44)]
MARTS = ("monthly_sales", "customer_rfm", "cart_abandonment", "access_summary", "threat_events", "user_risk")


def whole(spark, data):
    s = silver.all_silver(raw_frames(spark, users=USERS, **data))
    args = {"monthly_sales": ("orders",), "customer_rfm": ("orders", "users"),
            "cart_abandonment": ("sessions",), "access_summary": ("access_logs",),
            "threat_events": ("access_logs",), "user_risk": ("access_logs", "users")}
    return {m: getattr(marts, m)(*(s[a] for a in args[m])) for m in MARTS}


def facts(spark, data):
    raw = raw_frames(spark, **data)
    return Lazy({f: lambda f=f: raw[f] for f in R.FACTS})


def check(spark, kept, data):
    users = silver.all_silver(raw_frames(spark, users=USERS))["users"]
    for name, want in whole(spark, data).items():
        got = kept.mart(name, users)
        assert got.columns == want.columns, name
        assert dict(got.dtypes) == dict(want.dtypes), name
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), name


def files_of(kept, name):
    top = os.path.join(urlparse(kept.location).path, name)
    return {os.path.join(d, f)[len(top):]: os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet")}


def test_three_batches_equal_a_full_rebuild(spark):
    data = rows()
    data["orders"] += [order(7000 + i, 1, None, category="a") for i in range(4)]
    part = {k: {f: [r for r in v if r[0] % 3 == k] for f, v in data.items()} for k in range(3)}
    kept = R.MonthlyMarts(spark)
    for k in range(3):
        kept.add(facts(spark, part[k]), f"batch{k}")
    check(spark, kept, data)
    # a batch that runs again replaces itself
    kept.add(facts(spark, part[1]), "batch1")
    check(spark, kept, data)


def test_a_new_month_rewrites_only_its_partitions(spark):
    data = rows(2)
    date = {"orders": 2, "sessions": 5, "access_logs": 2}
    old = {f: [r for r in v if r[date[f]] < "2025-06"] for f, v in data.items()}
    new = {f: [r for r in v if r[date[f]] >= "2025-06"] for f, v in data.items()}
    kept = R.MonthlyMarts(spark)
    kept.add(facts(spark, old), "old")
    before = {name: files_of(kept, name) for name in R.BY_MONTH}
    changed = kept.add(facts(spark, new), "new")
    assert changed == {f: ["2025-06"] for f in R.FACTS}
    for name, files in before.items():
        after = files_of(kept, name)
        assert all(after[f] == t for f, t in files.items()), name      # untouched
        assert all("2025-06" in f for f in set(after) - set(files)) and len(after) > len(files), name
    check(spark, kept, data)


def test_a_late_row_reads_its_month_only(spark):
    data = rows(3)
    kept = R.MonthlyMarts(spark)
    kept.add(facts(spark, data), "all")
    late = {"orders": [order(9001, 2, "2025-02-28", category="a")]}
    raw = raw_frames(spark, **late)
    assert kept.add({"orders": raw["orders"]}, "late") == {"orders": ["2025-02"]}
    table = kept.read("silver_orders")
    plan = table.filter(table.ym.isin(["2025-02"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan or "PartitionFilters: [ym" in plan
    check(spark, kept, {**data, "orders": data["orders"] + late["orders"]})


@pytest.mark.parametrize("fact", R.FACTS)
def test_one_kind_of_facts_alone(spark, fact):
    data = rows(4, 40)
    kept = R.MonthlyMarts(spark)
    kept.add({fact: raw_frames(spark, **data)[fact]}, "only")
    name = next(n for n, v in R.BY_MONTH.items() if v[0] == fact)
    want = whole(spark, data)[name]
    assert Counter(map(tuple, kept.mart(name).collect())) == Counter(map(tuple, want.collect()))
