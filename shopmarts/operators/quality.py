"""Data-quality checks (V1-V8): each returns the offending rows, so a clean
input gives an empty DataFrame and a broken one gives exactly the planted rows.

All checks are joins or aggregations on keys; none collects to the driver.
Fact-side aggregates are computed before they are joined, and set-membership
sides are deduplicated first, so a hot key cannot blow up a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.session import shared_path
from shopmarts.sources.files import CORRUPT, write_counted

# The value domains of the raw data.
DOMAINS = {
    ("orders", "status"): ("completed", "cancelled", "returned"),
    ("orders", "channel"): ("web", "mobile", "app"),
    ("sessions", "event_type"): ("view", "add_to_cart", "purchase", "abandon"),
    ("access_logs", "event_type"): ("login", "page_view", "add_to_cart", "purchase_attempt"),
    ("access_logs", "threat_type"): ("normal", "brute_force", "bot", "fraud"),
}

KEYS = {"users": "user_id", "products": "product_id", "orders": "order_id",
        "order_items": "item_id", "sessions": "session_id", "access_logs": "access_id"}

DATE_COLUMNS = {("users", "registration_date"): "date", ("orders", "order_date"): "date",
                ("sessions", "session_date"): "date", ("access_logs", "timestamp"): "timestamp"}

KEYS_PER_TASK = 1 << 19


def item_subtotal(order_items: DataFrame) -> DataFrame:
    """V1: subtotal must equal unit_price x quantity."""
    expected = F.col("unit_price").cast("long") * F.col("quantity")
    return (order_items.filter(~F.col("subtotal").eqNullSafe(expected))
            .select("item_id", "order_id", "quantity", "unit_price", "subtotal",
                    expected.alias("expected_subtotal")))


def order_total(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """V2: an order's total must equal the sum of its item subtotals.

    Items are summed per order first (partial aggregation map-side), then full
    outer joined on the unique order key."""
    sums = order_items.groupBy("order_id").agg(F.sum("subtotal").alias("item_total"))
    j = orders.select("order_id", "total_amount").join(sums, "order_id", "full_outer")
    issue = (F.when(F.col("total_amount").isNull() & F.col("item_total").isNotNull(), "no_order")
             .when(F.col("item_total").isNull(), "no_items")
             .when(F.col("total_amount") != F.col("item_total"), "mismatch"))
    return (j.select("order_id", "total_amount", "item_total", issue.alias("issue"))
            .filter(F.col("issue").isNotNull()))


def orphans(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """V3: items whose order or product does not exist; one pass over the items."""
    cols = ["item_id", "order_id", "product_id"]
    known_o = orders.select(F.col("order_id").alias("o")).distinct()
    known_p = products.select(F.col("product_id").alias("p")).distinct()
    issues = F.array_compact(F.array(F.when(F.col("o").isNull(), "unknown_order"),
                                     F.when(F.col("p").isNull(), "unknown_product")))
    return (order_items.select(*cols)
            .join(known_o, F.col("order_id") == F.col("o"), "left")
            .join(known_p, F.col("product_id") == F.col("p"), "left")
            .select(*cols, F.explode(issues).alias("issue")))


def category_match(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """V4: an item's product must belong to its order's category."""
    o = orders.select("order_id", F.col("category").alias("order_category")).distinct()
    p = products.select("product_id", F.col("category").alias("product_category")).distinct()
    return (order_items.select("item_id", "order_id", "product_id")
            .join(o, "order_id").join(p, "product_id")
            .filter(~F.col("order_category").eqNullSafe(F.col("product_category")))
            .select("item_id", "order_id", "product_id", "order_category", "product_category"))


def duplicate_keys(raw: dict[str, DataFrame], rows_per_task: int = KEYS_PER_TASK) -> DataFrame:
    """V5: keys that occur more than once, per table.

    Nearly all keys are distinct, so a task's table of counts grows with its rows.
    The keys are written once, which counts them, and dealt by key to tasks of about
    ``rows_per_task`` rows: more rows make more tasks, not larger ones."""
    parts = []
    for t in (t for t in raw if t in KEYS):
        keys = raw[t].select(F.col(KEYS[t]).cast("string").alias("key_value"))
        path = shared_path(keys.sparkSession, "steps", f"keys_{t}", unique=True)
        rows = write_counted(keys, lambda d: d.write.parquet(path))
        keys = keys.sparkSession.read.schema(keys.schema).parquet(path)
        parts.append(keys.repartition(max(1, -(-rows // rows_per_task)), "key_value")
                     .groupBy("key_value").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > 1)
                     .select(F.lit(t).alias("table_name"), "key_value", "n"))
    return reduce(DataFrame.unionByName, parts)


def domains(raw: dict[str, DataFrame]) -> DataFrame:
    """V6: value histogram of every domain-bound column, flagged in or out; one
    pass per table, its checked columns as (column, value) pairs."""
    parts = []
    for t in dict.fromkeys(t for t, _ in DOMAINS if t in raw):
        own = {c: allowed for (u, c), allowed in DOMAINS.items() if u == t}
        pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"),
                                   F.coalesce(F.col(c).isin(*allowed), F.lit(False)).alias("in_domain"))
                          for c, allowed in own.items()))
        parts.append(raw[t].select(F.inline(pairs))
                     .groupBy("column_name", "value", "in_domain").agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(t).alias("table_name"), "column_name", "value", "n", "in_domain"))
    return reduce(DataFrame.unionByName, parts)


def bot_orders(orders: DataFrame, access_logs: DataFrame) -> DataFrame:
    """V7: orders placed by users seen acting as bots (bots never order)."""
    bots = access_logs.filter(F.col("threat_type") == "bot").select("user_id").distinct()
    return (orders.join(bots, "user_id", "left_semi")
            .select("order_id", "user_id", "status", "order_date"))


def rejects(raw: dict[str, DataFrame]) -> DataFrame:
    """V8: raw date/timestamp strings that would fail the strict silver cast, and
    the raw text of rows that are not well-formed CSV."""
    parts = [df.filter(F.col(CORRUPT).isNotNull())
             .select(F.lit(t).alias("table_name"), F.col(KEYS[t]).cast("string").alias("key_value"),
                     F.lit(CORRUPT).alias("column_name"), F.col(CORRUPT).alias("raw_value"))
             for t, df in raw.items() if CORRUPT in df.columns]
    for (t, c), typ in DATE_COLUMNS.items():
        if t in raw:
            v = F.col(c)
            parts.append(raw[t].filter(v.isNotNull() & v.try_cast(typ).isNull())
                         .select(F.lit(t).alias("table_name"),
                                 F.col(KEYS[t]).cast("string").alias("key_value"),
                                 F.lit(c).alias("column_name"), v.alias("raw_value")))
    return reduce(DataFrame.unionByName, parts)
