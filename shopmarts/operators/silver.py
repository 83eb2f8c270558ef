"""Bronze -> silver: typed dates and derived columns (narrow stages, no shuffle).

Casts are strict: under ANSI mode a malformed date raises.  ``quality.rejects``
lists such rows before the cast runs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.functions import buckets
from shopmarts.sources.tables import Lazy


def users(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "registration_date": F.col("registration_date").cast("date"),
        "age_group": buckets.age_group(F.col("age")),
    })


def products(df: DataFrame) -> DataFrame:
    return df


def orders(df: DataFrame) -> DataFrame:
    d = F.col("order_date")
    return df.withColumns({
        "order_date": d.cast("date"),
        "year": F.year(d.cast("date")),
        "month": F.month(d.cast("date")),
        "ym": F.date_format(d.cast("date"), "yyyy-MM"),
    })


def order_items(df: DataFrame) -> DataFrame:
    return df


def sessions(df: DataFrame) -> DataFrame:
    d = F.col("session_date").cast("date")
    return df.withColumns({"session_date": d, "ym": F.date_format(d, "yyyy-MM")})


def access_logs(df: DataFrame) -> DataFrame:
    # Wall-clock timestamps without zone: TIMESTAMP_NTZ keeps hour/date independent
    # of the session time zone of whichever cluster runs this.
    ts = F.col("timestamp").cast("timestamp_ntz")
    hour = F.hour(ts)
    return df.withColumns({
        "timestamp": ts,
        "access_date": F.to_date(ts),
        "hour": hour,
        "ym": F.date_format(ts, "yyyy-MM"),
        "time_zone": buckets.time_band(hour),
    })


SILVER = {
    "users": users,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "sessions": sessions,
    "access_logs": access_logs,
}


def all_silver(raw: Mapping[str, DataFrame]) -> Lazy:
    """The silver tables of all raw ones, each built when it is first used."""
    return Lazy({name: lambda name=name: SILVER[name](raw[name]) for name in raw})
