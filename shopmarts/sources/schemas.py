"""Explicit schemas of the six raw inputs.

Fixed values: the column names, order and types below must equal the
reference's raw files, so that position-bound CSV columns land right.
"""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

I, S = IntegerType(), StringType()


def _schema(*cols):
    return StructType([StructField(n, t) for n, t in cols])


# Fixed values (column names and types of the raw files).
USERS = _schema(("user_id", I), ("name", S), ("age", I), ("gender", S), ("prefecture", S),
                ("registration_date", S), ("email", S))
PRODUCTS = _schema(("product_id", I), ("product_name", S), ("category", S), ("price", I),
                   ("cost", I))
ORDERS = _schema(("order_id", I), ("user_id", I), ("order_date", S), ("status", S),
                 ("total_amount", I), ("channel", S), ("category", S))
ORDER_ITEMS = _schema(("item_id", I), ("order_id", I), ("product_id", I), ("quantity", I),
                      ("unit_price", I), ("subtotal", I))
SESSIONS = _schema(("session_id", I), ("user_id", I), ("product_id", I), ("category", S),
                   ("event_type", S), ("session_date", S))
ACCESS_LOGS = _schema(("access_id", I), ("user_id", I), ("timestamp", S), ("ip_address", S),
                      ("user_agent", S), ("success", I), ("event_type", S), ("threat_type", S))

RAW_SCHEMAS = {
    "users": USERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "sessions": SESSIONS,
    "access_logs": ACCESS_LOGS,
}
RAW_TABLES = tuple(RAW_SCHEMAS)
