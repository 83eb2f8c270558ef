import uuid

import pytest
from pyspark.sql import functions as F

from shopmarts.plans import catalog as C
from shopmarts.plans import pipeline as PL
from shopmarts.session import shared_path
from shopmarts.sources import files
from shopmarts.sources.schemas import ORDERS, RAW_TABLES
from tests.fixtures import access, order, raw_frames, user

HEADER = "order_id,user_id,order_date,status,total_amount,channel,category"


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_bytes(text.encode("utf-8"))
    return str(p)


def test_csv_cases(spark, tmp_path):
    body = (HEADER + "\r\n"
            "1,10,2025-01-01,completed,100,web,\"食品, 飲料\"\r\n"   # CRLF + quoted comma
            "2,11,2025-01-02,completed\r\n"                          # short row
            "3,12,2025-01-03,completed,300,web,食品,extra\r\n"       # long row
            "x4,13,2025-01-04,completed,400,web,食品\r\n")           # non-numeric id
    df = files.read_csv(spark, _write(tmp_path, "o.csv", body), ORDERS, keep_corrupt=True)
    rows = {r.user_id: r for r in df.collect()}
    assert rows[10].category == "食品, 飲料" and rows[10].order_id == 1
    assert rows[11].total_amount is None and rows[11].category is None
    assert rows[13].order_id is None and rows[13][files.CORRUPT] is not None


def test_reordered_header_raises(spark, tmp_path):
    bad = "user_id,order_id,order_date,status,total_amount,channel,category\n1,2,2025-01-01,x,1,web,a\n"
    with pytest.raises(Exception):
        files.read_csv(spark, _write(tmp_path, "bad.csv", bad), ORDERS).collect()


def test_csv_roundtrip_keeps_rows(spark):
    raw = raw_frames(spark, orders=[order(1, 1, "2025-01-01", category='a "quoted", value')])
    path = shared_path(spark, "test_csv", unique=True)
    files.write_csv(raw["orders"], path)
    assert files.read_csv(spark, path, ORDERS).collect() == raw["orders"].collect()


def test_csv_values_come_back_as_they_were(spark):
    values = ["plain", "two\nlines", 'quo"te', '"whole"', "back\\slash", "tail\\", "", None, "  padded ",
              "comma, here", "tab\there", "'", '""', "日本 é"]
    raw = raw_frames(spark, orders=[order(i, 1, "2025-01-01", category=v)
                                    for i, v in enumerate(values)])["orders"]
    path = shared_path(spark, "test_csv", unique=True)
    files.write_csv(raw, path)
    got = {r.order_id: r.category for r in files.read_csv(spark, path, ORDERS).collect()}
    assert got == dict(enumerate(values))


def test_malformed_rows_are_reported_and_kept_out_of_bronze(spark, tmp_path):
    from shopmarts.operators import quality
    body = HEADER + "\n1,10,2025-01-01,completed,100,web,a\nx4,13,2025-01-04,completed,400,web,b\n"
    df = files.read_csv(spark, _write(tmp_path, "o.csv", body), ORDERS, keep_corrupt=True)
    assert [r.order_id for r in PL.parsed(df).collect()] == [1]
    bad = quality.rejects({"orders": df}).collect()
    assert [(r.table_name, r.column_name) for r in bad] == [("orders", files.CORRUPT)]
    assert bad[0].raw_value.startswith("x4,13")


def test_item_ids_stay_distinct_for_wide_keys(spark):
    from shopmarts.sources import adapters
    rows = [(10 ** 12, 10 ** 9, 1, 1), (1, 100001, 1, 1), (2, 1, 1, 1), (1, 1, 1, 1)]
    df = spark.createDataFrame([(*r, 1.0, 10.0) for r in rows],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
                               " l_quantity double, l_extendedprice double")
    assert adapters.order_items(df).select("item_id").distinct().count() == 4


def test_pipeline_end_to_end_from_csv(spark):
    raw = raw_frames(spark, users=[user(1), user(2, age=25)],
                     products=[(1, "p", "食品", 100, 50)],
                     orders=[order(1, 1, "2025-01-01"), order(2, 2, "2025-02-01")],
                     order_items=[(1, 1, 1, 10, 100, 1000)],
                     sessions=[(1, 1, 1, "食品", "abandon", "2025-01-01")],
                     access_logs=[access(1, 1), access(2, 3, threat="bot")])
    src = shared_path(spark, "test_src", unique=True)
    for t in RAW_TABLES:
        files.write_csv(raw[t], f"{src}/{t}.csv")
    db = f"t_{uuid.uuid4().hex[:8]}"
    counts = {(r.layer, r.table_name): r.row_count
              for r in PL.run_pipeline(spark, PL.raw_from_csv(spark, src), db).collect()}
    assert len(counts) == 18
    assert counts[("bronze", "orders")] == counts[("silver", "orders")] == 2
    assert counts[("gold", "monthly_sales")] == 2 and counts[("gold", "user_risk")] == 2
    assert spark.table(f"{db}.gold_customer_rfm").count() == 2
    cat = C.table_catalog(spark, db)
    assert cat.filter(F.col("column_comment").isNotNull()).count() == 30
    assert cat.select("table_comment").distinct().count() == 6
    hit = C.search_catalog(cat, "バスケット落ち").collect()
    assert [(r.table_name, r.column_name) for r in hit] == [("gold_cart_abandonment",
                                                              "abandonment_rate")]
    # re-running overwrites every table and re-applies the comments
    PL.run_pipeline(spark, PL.raw_from_csv(spark, src), db)
    assert C.table_catalog(spark, db).filter(F.col("column_comment").isNotNull()).count() == 30


def test_save_table_counts_and_replaces_schema(spark):
    db = f"t_{uuid.uuid4().hex[:8]}"
    PL.create_database(spark, db, shared_path(spark, "warehouse", db))
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert files.save_table(df.select("id"), f"{db}.t") == 5
    assert files.save_table(df, f"{db}.t") == 5
    assert spark.table(f"{db}.t").columns == ["id", "x"]


def test_document_inventory_gate(spark):
    inv = files.document_inventory(spark, "/root/testdata/sf0.001", "*.parquet")
    assert inv.count() == 14 and {"name", "size"} == set(inv.columns)
    assert files.require_documents(inv, 10) is inv
    with pytest.raises(ValueError):
        files.require_documents(inv, 15)
