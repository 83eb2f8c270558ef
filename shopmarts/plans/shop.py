"""One scale-factor folder seen as the shop: raw shapes, silver tables, marts.

Everything is a lazy DataFrame; nothing is cached or collected.  Catalyst sees
each query whole, so it prunes columns and pushes filters down to the parquet
scans of the driver tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shopmarts.operators import marts, silver
from shopmarts.sources import adapters
from shopmarts.sources.tables import DriverTables


class Shop:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = DriverTables(spark, sf_dir) if sf_dir else None
        self._raw = raw

    # ---------------------------------------------------------------- layers
    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return self._raw if self._raw is not None else adapters.from_driver(self.t)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return silver.all_silver(self.raw)

    # ---------------------------------------------------------------- marts
    def monthly_sales(self) -> DataFrame:
        return marts.monthly_sales(self.silver["orders"])

    def rfm_base(self) -> DataFrame:
        return marts.rfm_base(self.silver["orders"])

    def rfm_scores(self) -> DataFrame:
        return marts.rfm_scores(self.rfm_base())

    def customer_rfm(self) -> DataFrame:
        return marts.customer_rfm(self.silver["orders"], self.silver["users"])

    def cart_abandonment(self) -> DataFrame:
        return marts.cart_abandonment(self.silver["sessions"])

    def access_summary(self) -> DataFrame:
        return marts.access_summary(self.silver["access_logs"])

    def threat_events(self) -> DataFrame:
        return marts.threat_events(self.silver["access_logs"])

    def risk_counters(self) -> DataFrame:
        return marts.risk_counters(self.silver["access_logs"])

    def risk_scores(self) -> DataFrame:
        return marts.risk_scores(self.silver["access_logs"])

    def user_risk(self) -> DataFrame:
        return marts.user_risk(self.silver["access_logs"], self.silver["users"])
