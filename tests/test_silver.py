import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopmarts.operators import silver
from tests.fixtures import access, order, raw_frames, user


def test_age_groups_edges_and_null(spark):
    ages = {1: 29, 2: 30, 3: 39, 4: 40, 5: 49, 6: 50, 7: None}
    raw = raw_frames(spark, users=[user(u, age=a) for u, a in ages.items()])
    got = {r.user_id: r.age_group for r in silver.users(raw["users"]).collect()}
    assert got == {1: "10-20代", 2: "30代", 3: "30代", 4: "40代", 5: "40代", 6: "50代以上",
                   7: "50代以上"}


def test_registration_date_is_date(spark):
    raw = raw_frames(spark, users=[user(1, reg="2023-01-31")])
    assert silver.users(raw["users"]).first().registration_date == dt.date(2023, 1, 31)


def test_time_bands(spark):
    hours = [1, 18, 23, 2, 5, 6, 11, 12, 17]
    rows = [access(i, 1, ts=f"2025-03-04 {h:02d}:15:00") for i, h in enumerate(hours)]
    rows.append(access(99, 1, ts=None))
    got = {r.access_id: r.time_zone for r in silver.access_logs(raw_frames(
        spark, access_logs=rows)["access_logs"]).collect()}
    want = ["夜間", "夜間", "夜間", "深夜帯", "深夜帯", "午前", "午前", "午後", "午後"]
    assert [got[i] for i in range(len(hours))] == want
    assert got[99] == "夜間"  # NULL hour falls into the default band


def test_access_columns(spark):
    r = silver.access_logs(raw_frames(spark, access_logs=[
        access(1, 1, ts="2024-02-29 23:59:58")])["access_logs"]).first()
    assert (r.access_date, r.hour, r.ym) == (dt.date(2024, 2, 29), 23, "2024-02")
    assert r.timestamp == dt.datetime(2024, 2, 29, 23, 59, 58)


def test_orders_leap_day(spark):
    r = silver.orders(raw_frames(spark, orders=[order(1, 1, "2024-02-29")])["orders"]).first()
    assert (r.order_date, r.year, r.month, r.ym) == (dt.date(2024, 2, 29), 2024, 2, "2024-02")


def test_sessions_ym(spark):
    raw = raw_frames(spark, sessions=[(1, 1, 1, "食品", "view", "2025-12-31")])
    assert silver.sessions(raw["sessions"]).first().ym == "2025-12"


def test_strict_cast_rejects_bad_date(spark):
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("strict casts need ANSI mode")
    raw = raw_frames(spark, orders=[order(1, 1, "2024-13-01")])
    with pytest.raises(Exception):
        silver.orders(raw["orders"]).collect()


def test_products_and_items_pass_through(spark):
    raw = raw_frames(spark, products=[(1, "p", "食品", 100, 50)],
                     order_items=[(1, 1, 1, 2, 100, 200)])
    assert silver.products(raw["products"]).collect() == raw["products"].collect()
    assert silver.order_items(raw["order_items"]).collect() == raw["order_items"].collect()
    assert silver.orders(raw["orders"]).filter(F.lit(False)).count() == 0
