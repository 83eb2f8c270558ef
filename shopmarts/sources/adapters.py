"""Driver tables -> the six raw shop shapes.

The driver ships TPC-H-like tables plus an ``events`` stream; the shop pipeline
reads users, products, orders, order items, sessions and access logs.  Each
adapter is a deterministic projection (one narrow stage, no shuffle except the
``nation`` lookup, which Catalyst broadcasts because its size is bounded by the
schema: 25 rows at every scale).  Dates and timestamps are emitted as *strings*,
exactly like the raw CSV files, so that the silver casts really run.

The same mappings are written in DuckDB SQL in ``shopmarts.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.sources.tables import Lazy

# Fixed values of the mapping (chosen by us, mirrored in the SQL oracle).
STATUS_BY_CODE = {"F": "completed", "O": "cancelled", "P": "returned"}
CHANNELS = ("web", "mobile", "app")                      # by o_orderkey % 3
SESSION_EVENT_BY_EVENT = {"view": "view", "signup": "view", "click": "add_to_cart",
                          "purchase": "purchase", "error": "abandon"}
USER_AGENTS = ("shop-web/desktop", "shop-web/mobile", "shop-app/ios",
               "shop-app/android")                       # by event_id % 4
REGISTRATION_EPOCH = "2023-01-01"
MONTH_SPREAD = 24          # events cover one month; spread them over 24 months
DAYS_PER_STEP = 30


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out.otherwise(default) if default is not None else out


def users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    n = nation.select("n_nationkey", "n_name")
    return (customer.join(n, customer.c_nationkey == n.n_nationkey, "left")
            .select(key.alias("user_id"),
                    F.col("c_name").alias("name"),
                    (F.lit(18) + key % 48).cast("int").alias("age"),
                    F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
                    F.col("n_name").alias("prefecture"),
                    F.date_format(F.date_add(F.lit(REGISTRATION_EPOCH).cast("date"),
                                             (key % 701).cast("int")),
                                  "yyyy-MM-dd").alias("registration_date"),
                    F.concat(F.lit("user"), key.cast("string"),
                             F.lit("@example.com")).alias("email")))


def products(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("product_id"),
                       F.col("p_name").alias("product_name"),
                       F.col("p_type").alias("category"),
                       F.floor("p_retailprice").cast("int").alias("price"),
                       F.floor(F.col("p_retailprice") / 2).cast("int").alias("cost"))


def orders(orders_t: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders_t.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        _case(F.col("o_orderstatus"), STATUS_BY_CODE).alias("status"),
        F.floor(F.col("o_totalprice") / 10).cast("int").alias("total_amount"),
        _case(k % 3, dict(enumerate(CHANNELS))).alias("channel"),
        F.col("o_orderpriority").alias("category"))


def order_items(lineitem: DataFrame) -> DataFrame:
    # a delimited text: distinct for keys of any width
    item_id = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return (lineitem.select(
                item_id.alias("item_id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.floor(F.col("l_extendedprice") / 10).cast("int").alias("subtotal"))
            .select("item_id", "order_id", "product_id", "quantity",
                    F.expr("CAST(CASE WHEN quantity <> 0 THEN subtotal div quantity END AS INT)")
                     .alias("unit_price"),
                    "subtotal"))


def shifted_ts() -> Column:
    """Event time moved by 30 days x ((event_id div 7) % 24): 24 months of data."""
    steps = F.expr(f"CAST((event_id div 7) % {MONTH_SPREAD} AS INT)")
    return F.col("ts") + F.make_dt_interval(days=steps * DAYS_PER_STEP)


def sessions(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return events.select(
        eid.alias("session_id"),
        F.col("user_id"),
        (eid % 200).alias("product_id"),
        F.concat(F.lit("cat"), (eid % 8).cast("string")).alias("category"),
        _case(F.col("event_type"), SESSION_EVENT_BY_EVENT).alias("event_type"),
        F.date_format(shifted_ts(), "yyyy-MM-dd").alias("session_date"))


def threat_of(eid: Column) -> Column:
    return (F.when(eid % 200 == 0, "fraud").when(eid % 100 == 1, "bot")
            .when(eid % 50 == 2, "brute_force").otherwise("normal"))


def access_logs(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    threat = threat_of(eid)
    return events.select(
        eid.alias("access_id"),
        F.col("user_id"),
        F.date_format(shifted_ts(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("198.51.100."), (eid % 250).cast("string")).alias("ip_address"),
        _case(eid % 4, dict(enumerate(USER_AGENTS))).alias("user_agent"),
        F.when((F.col("event_type") == "error") & (eid % 4 == 0), 0).otherwise(1)
         .alias("success"),
        F.when(threat == "fraud", "purchase_attempt").when(threat == "bot", "page_view")
         .otherwise("login").alias("event_type"),
        threat.alias("threat_type"))


def from_driver(t) -> Lazy:
    """All six raw shapes from a ``DriverTables``, each built when it is first used."""
    return Lazy({
        "users": lambda: users(t.customer, t.nation),
        "products": lambda: products(t.part),
        "orders": lambda: orders(t.orders),
        "order_items": lambda: order_items(t.lineitem),
        "sessions": lambda: sessions(t.events),
        "access_logs": lambda: access_logs(t.events),
    })


def with_line_breaks(orders_: DataFrame) -> DataFrame:
    """Raw orders whose categories hold line breaks, quotes and commas where the key
    says so (every 5th), as free text in a CSV file may."""
    key = F.col("order_id").cast("string")
    text = F.concat(F.col("category"), F.lit('\n"no. '), key, F.lit('",\n\n'))
    return orders_.withColumn("category", F.when(F.col("order_id") % 5 == 0, text)
                              .otherwise(F.col("category")))


# ---------------------------------------------------------------- faulty shapes
# Fixed values of the fault rules (chosen by us, mirrored in the SQL oracle).
REPEAT_EVERY = 251        # keys divisible by this occur twice
LOST_EVERY = 97           # references divisible by this point nowhere
BAD_DATE_EVERY = 89       # keys divisible by this have an unparsable date
WRONG_EVERY = 7           # orders divisible by this keep totals and items that differ
N_CATEGORIES = 8


def with_faults(raw: Mapping[str, DataFrame]) -> Lazy:
    """The raw shapes as input of the quality checks: consistent but for faults
    that follow from the rows' own keys.

    Categories are ``cat0`` .. ``cat7`` by order and product key, items' subtotals
    are quantity times unit price and orders' totals the sum of their items,
    except in orders divisible by ``WRONG_EVERY``; some keys occur twice, some
    references point nowhere, some dates do not parse."""
    def category(key):
        return F.concat(F.lit("cat"), (F.col(key) % N_CATEGORIES).cast("string"))

    def twice(df, key):
        return df.unionByName(df.filter(F.col(key) % REPEAT_EVERY == 0))

    def bad_date(key, col):
        return F.when(F.col(key) % BAD_DATE_EVERY == 0, F.concat(F.col(col), F.lit("?"))
                      ).otherwise(F.col(col))

    wrong = F.col("order_id") % WRONG_EVERY == 0
    lost = lambda c: F.when(F.col(c) % LOST_EVERY == 0, -F.col(c)).otherwise(F.col(c))

    def priced():
        return raw["order_items"].withColumn("subtotal", F.when(wrong, F.col("subtotal")).otherwise(
            F.col("unit_price") * F.col("quantity")))

    def summed():
        sums = priced().groupBy(F.col("order_id").alias("of")).agg(F.sum("subtotal").alias("items"))
        out = raw["orders"].join(sums, F.col("order_id") == F.col("of"), "left").withColumn(
            "total_amount", F.when(wrong, F.col("total_amount")).otherwise(F.col("items"))
            .cast("int")).drop("of", "items")
        return twice(out.withColumns({"category": category("order_id"),
                                      "order_date": bad_date("order_id", "order_date")}), "order_id")

    return Lazy({
        "users": lambda: twice(raw["users"], "user_id"),
        "products": lambda: raw["products"].withColumn("category", category("product_id")),
        "orders": summed,
        "order_items": lambda: priced().withColumns({c: lost(c) for c in ("order_id", "product_id")}),
        "sessions": lambda: raw["sessions"].withColumn(
            "session_date", bad_date("session_id", "session_date")),
        "access_logs": lambda: raw["access_logs"].withColumn(
            "timestamp", bad_date("access_id", "timestamp")),
    })


# ---------------------------------------------------------------- evaluation shapes
SPAN_STEP_MS = 1000   # a turn starts every second; it lasts one ms per character


def spans(conversations: DataFrame) -> DataFrame:
    """Agent-trace spans: trace = conversation, span = turn, agent = role.

    (trace_id, span_id, agent, start_ms, end_ms); a long turn outlasts the next
    turn's start, which makes those two calls overlap (run in parallel)."""
    start = F.col("turn") * SPAN_STEP_MS
    return conversations.select(
        F.col("conv_id").alias("trace_id"), F.col("turn").alias("span_id"),
        F.col("role").alias("agent"), start.alias("start_ms"),
        (start + F.length("text")).cast("long").alias("end_ms"))


def verdicts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Judge verdicts per document: run = source, judges 'quality' and 'safety'.

    (run_id, trace_id, judge, verdict) with verdict 'pass', 'fail' or NULL when
    the document has no label (an empty verdict)."""
    j = documents.select("doc_id", "source").join(labels, "doc_id", "left")
    quality = F.when(F.col("quality") == 1, "pass").when(F.col("quality") == 0, "fail")
    safety = F.when(F.col("toxic") == 0, "pass").when(F.col("toxic") == 1, "fail")
    pairs = F.array(F.struct(F.lit("quality").alias("judge"), quality.alias("verdict")),
                    F.struct(F.lit("safety").alias("judge"), safety.alias("verdict")))
    return (j.select(F.col("source").alias("run_id"), F.col("doc_id").alias("trace_id"),
                     F.inline(pairs)))
