from pyspark.sql import functions as F

from shopmarts.operators import quality as V
from tests.fixtures import access, order, raw_frames, user


def _clean():
    users = [user(1), user(2), user(991)]
    products = [(1, "コーヒー豆", "食品", 1500, 700), (2, "ノートPC", "電子機器", 90000, 55000)]
    orders = [order(1, 1, "2025-01-02", total=3000, category="食品"),
              order(2, 2, "2025-01-03", total=90000, category="電子機器")]
    items = [(1, 1, 1, 2, 1500, 3000), (2, 2, 2, 1, 90000, 90000)]
    sessions = [(1, 1, 1, "食品", "view", "2025-01-02")]
    logs = [access(1, 1), access(2, 991, threat="bot", event="page_view")]
    return dict(users=users, products=products, orders=orders, order_items=items,
                sessions=sessions, access_logs=logs)


def _checks(raw):
    return {
        "subtotal": V.item_subtotal(raw["order_items"]),
        "total": V.order_total(raw["orders"], raw["order_items"]),
        "orphans": V.orphans(raw["order_items"], raw["orders"], raw["products"]),
        "category": V.category_match(raw["order_items"], raw["orders"], raw["products"]),
        "dupes": V.duplicate_keys(raw),
        "bots": V.bot_orders(raw["orders"], raw["access_logs"]),
        "rejects": V.rejects(raw),
    }


def test_clean_fixture_has_no_findings(spark):
    raw = raw_frames(spark, **_clean())
    for name, df in _checks(raw).items():
        assert df.count() == 0, name
    assert V.domains(raw).filter("NOT in_domain").count() == 0


def test_planted_rows_are_found(spark):
    rows = _clean()
    rows["order_items"] += [(3, 1, 1, 2, 1500, 3001),      # subtotal != price x qty
                            (4, 77, 1, 1, 1500, 1500),     # item without order
                            (5, 2, 9, 1, 10, 10),          # unknown product
                            (6, 2, 1, 1, 1500, 1500)]      # product of another category
    rows["orders"] += [order(3, 2, "2025-01-05", status="shipped", total=0),  # bad status
                       order(2, 2, "2025-01-03", total=90000, category="電子機器"),  # repeated id
                       order(4, 991, "2024-13-01")]        # bot order with a bad date
    raw = raw_frames(spark, **rows)
    c = _checks(raw)
    assert [r.item_id for r in c["subtotal"].collect()] == [3]
    issues = {(r.order_id, r.issue) for r in c["total"].collect()}
    assert (77, "no_order") in issues and (1, "mismatch") in issues and (4, "no_items") in issues
    assert {(r.item_id, r.issue) for r in c["orphans"].collect()} == \
        {(4, "unknown_order"), (5, "unknown_product")}
    assert 6 in {r.item_id for r in c["category"].collect()}
    assert {(r.table_name, r.key_value) for r in c["dupes"].collect()} == {("orders", "2")}
    assert [r.order_id for r in c["bots"].collect()] == [4]
    assert [(r.table_name, r.raw_value) for r in c["rejects"].collect()] == \
        [("orders", "2024-13-01")]
    bad = {(r.column_name, r.value) for r in V.domains(raw).filter("NOT in_domain").collect()}
    assert bad == {("status", "shipped")}


def test_duplicate_keys_use_more_tasks_for_more_rows(spark):
    users = spark.range(100).select(F.when(F.col("id") > 1, F.col("id")).alias("user_id"))
    users = users.unionByName(users.filter("user_id % 40 = 0"))
    out = V.duplicate_keys({"users": users}, rows_per_task=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and ", 11" in plan
    got = {(r.table_name, r.key_value, r.n) for r in out.collect()}
    assert got == {("users", None, 2), ("users", "40", 2), ("users", "80", 2)}
