"""Marts that are refreshed by month (S3, S10): new rows rewrite only the months
that they belong to.

Facts are kept as silver tables by batch and month.  Marts by month are rebuilt for
the months of a batch, from those months' facts alone, and replace their partitions
(dynamic partition overwrite).  RFM and risk span all months: for them a mergeable
state by month and user is kept (sums, latest values, the distinct source
addresses), so their marts add up states instead of reading the facts again.

A batch has a name and replaces itself: after a failure the same ``add`` runs again.
"""

from __future__ import annotations

import posixpath
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopmarts.functions import buckets as B
from shopmarts.operators import marts, silver
from shopmarts.session import shared_path

FACTS = ("orders", "sessions", "access_logs")


def rfm_state(orders: DataFrame) -> DataFrame:
    """Completed orders by month and user: latest date, number and amount."""
    return (orders.filter(F.col("status") == marts.COMPLETED).groupBy("ym", "user_id")
            .agg(F.max("order_date").alias("last_date"), F.count("order_id").alias("frequency"),
                 F.sum("total_amount").alias("monetary")))


def risk_state(access_logs: DataFrame) -> DataFrame:
    """Accesses by month and user: numbers by outcome and threat, and the latest."""
    threats = [B.count_when(F.col("threat_type") == kind).alias(name)
               for name, kind in marts.RISK_COUNTS.items()]
    return access_logs.groupBy("ym", "user_id").agg(
        F.count("access_id").alias("acc_cnt"), B.count_when(F.col("success") == 0).alias("fail_cnt"),
        *threats, F.max("timestamp").alias("last_ts"))


def source_state(access_logs: DataFrame) -> DataFrame:
    """The distinct source addresses of each user in each month."""
    return access_logs.filter("ip_address is not null").select("ym", "user_id", "ip_address").distinct()


#: What is kept by month: the fact table, the month's column and the way to make it.
BY_MONTH = {
    "monthly_sales": ("orders", "ym", marts.monthly_sales),
    "rfm_state": ("orders", "ym", rfm_state),
    "cart_abandonment": ("sessions", "ym", marts.cart_abandonment),
    "access_summary": ("access_logs", "period", marts.access_summary),
    "threat_events": ("access_logs", "period", marts.threat_events),
    "risk_state": ("access_logs", "ym", risk_state),
    "source_state": ("access_logs", "ym", source_state),
}


class MonthlyMarts:
    """Silver facts, marts and states under one folder."""

    def __init__(self, spark: SparkSession, location: str | None = None):
        self.spark = spark
        self.location = location or shared_path(spark, "monthly_marts", unique=True)
        self._schemas: dict[str, StructType] = {}
        self._order: dict[str, list[str]] = {}

    def _path(self, name: str) -> str:
        return posixpath.join(self.location, name)

    def _write(self, df: DataFrame, name: str, by: list[str]) -> None:
        """Replace the partitions that ``df`` has rows of; all others stay."""
        rest = [c for c in df.columns if c not in by]
        self._order[name] = df.columns
        self._schemas[name] = df.select(*rest, *by).schema
        (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(self._path(name)))

    def read(self, name: str) -> DataFrame:
        """A kept table; months are strings, never guessed to be dates."""
        return self.spark.read.schema(self._schemas[name]).parquet(self._path(name))

    def add(self, raw: Mapping[str, DataFrame], batch: str) -> dict[str, list[str]]:
        """Take a batch of raw facts; returns the months rebuilt, by fact table.

        Facts that ``raw`` does not hold stay as they are.  A month's rebuild reads
        that month's files only."""
        changed = {}
        for fact in FACTS:
            if fact not in raw:
                continue
            rows = silver.SILVER[fact](raw[fact]).withColumn("batch", F.lit(batch))
            self._write(rows, f"silver_{fact}", ["batch", "ym"])
            table = self.read(f"silver_{fact}")
            # one name a month, however many rows
            found = {r["ym"] for r in table.filter(F.col("batch") == batch).select("ym").distinct().collect()}
            changed[fact] = months = sorted(found - {None})
            of_batch = F.col("ym").isin(months)
            if None in found:                       # rows without a date have a group of their own
                of_batch = of_batch | F.col("ym").isNull()
            part = table.filter(of_batch).drop("batch")
            for name, (source, month, make) in BY_MONTH.items():
                if source == fact:
                    self._write(make(part), name, [month])
        return changed

    def mart(self, name: str, users: DataFrame | None = None) -> DataFrame:
        """A mart as the whole facts would give it; ``users`` (silver) for those by user."""
        if name == "customer_rfm":
            dim = users.select("user_id", "age", "age_group", "gender", "prefecture")
            return marts.rfm_scores(self._rfm_base()).join(dim, "user_id")
        if name == "user_risk":
            dim = users.select(F.col("user_id").alias("usr_ref"), "name", "age_group", "prefecture")
            return marts.scored_risk(self._risk_counters()).join(dim, "usr_ref", "left")
        return self.read(name).select(*self._order[name])

    def _rfm_base(self) -> DataFrame:
        state = self.read("rfm_state")
        latest = state.agg(F.max("last_date")).scalar()
        users = state.groupBy("user_id").agg(
            F.max("last_date").alias("last_date"), F.sum("frequency").alias("frequency"),
            F.sum("monetary").alias("monetary"))
        return users.select("user_id", F.datediff(latest, F.col("last_date")).alias("recency_days"),
                            "frequency", "monetary")

    def _risk_counters(self) -> DataFrame:
        numbers = ["acc_cnt", "fail_cnt", *marts.RISK_COUNTS]
        by = self.read("risk_state").groupBy("user_id").agg(
            *(F.sum(c).alias(c) for c in numbers), F.max("last_ts").alias("last_ts"))
        sources = self.read("source_state").groupBy("user_id").agg(
            F.countDistinct("ip_address").alias("uniq_src")).withColumnRenamed("user_id", "of")
        both = by.join(sources, F.col("user_id").eqNullSafe(F.col("of")), "left")
        return both.select("user_id", *numbers, F.coalesce("uniq_src", F.lit(0)).alias("uniq_src"),
                           "last_ts")
