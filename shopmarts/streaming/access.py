"""Access marts from a stream in event time (A7, A8; M4, M5).

Distinct counts can't be kept by a streaming aggregate, so the stream keeps what
they follow from: each micro-batch adds one row for every (month, threat, band,
source, user) that it holds, with its counts and times, and the marts add up these
rows.  Repeated events are dropped within the watermark's delay.

A micro-batch replaces its own folder, so one that runs again after a failure adds
nothing twice; the checkpoint holds the rest, and a new run goes on from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopmarts.functions import buckets as B
from shopmarts.operators import silver

KEYS = ["ym", "threat_type", "time_zone", "ip_address", "user_id"]


def access_rows(access_logs: DataFrame) -> DataFrame:
    """One row for each of ``KEYS``: events by outcome, first and last time.  Rows of
    several parts of a log may be put together."""
    ok = F.col("success")
    return access_logs.groupBy(*KEYS).agg(
        F.count("access_id").alias("events"), B.count_when(ok == 1).alias("passed"),
        B.count_when(ok == 0).alias("failed"), F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"))


class AccessStream:
    """The stream of raw access logs in ``source`` and its state in ``folder``."""

    def __init__(self, spark: SparkSession, source: str, schema: StructType, folder: str,
                 delay: str = "7 days", files_per_trigger: int = 8):
        self.spark, self.source, self.schema = spark, source, schema
        self.state, self.checkpoint = f"{folder}/state", f"{folder}/checkpoint"
        self.delay, self.files_per_trigger = delay, files_per_trigger

    def once(self) -> DataFrame:
        """The silver rows of the stream, each event once.

        An event is known by its id.  Events over ``delay`` older than the newest
        one of the micro-batches before are left out, repeated or not, and the
        ids kept for the comparison go as the watermark moves on."""
        raw = (self.spark.readStream.schema(self.schema)
               .option("maxFilesPerTrigger", self.files_per_trigger).parquet(self.source))
        rows = silver.SILVER["access_logs"](raw).withColumn(
            "event_time", F.col("timestamp").cast("timestamp"))
        return (rows.withWatermark("event_time", self.delay)
                .dropDuplicatesWithinWatermark(["access_id"]).drop("event_time"))

    def add_batch(self, batch: DataFrame, number: int) -> None:
        access_rows(batch).write.mode("overwrite").parquet(f"{self.state}/batch={number}")

    def catch_up(self) -> None:
        """Take all files that have arrived, in micro-batches, and stop."""
        query = (self.once().writeStream.foreachBatch(self.add_batch)
                 .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()

    def rows(self) -> DataFrame:
        """All rows of the state."""
        empty = self.spark.createDataFrame([], self.schema)
        schema = access_rows(silver.SILVER["access_logs"](empty)).schema
        return self.spark.read.schema(schema).parquet(f"{self.state}/batch=*")

    def access_summary(self) -> DataFrame:
        """M4 as of the last micro-batch."""
        by = self.rows().groupBy(F.col("ym").alias("period"), F.col("threat_type").alias("thr_cls"),
                                 F.col("time_zone").alias("tz_band")).agg(
            F.sum("events").alias("evt_cnt"), F.sum("passed").alias("succ_cnt"),
            F.sum("failed").alias("fail_cnt"), F.countDistinct("ip_address").alias("uniq_src"),
            F.countDistinct("user_id").alias("uniq_usr"))
        return by.withColumn("fail_pct", B.pct(F.col("fail_cnt"), F.col("evt_cnt")))

    def threat_events(self) -> DataFrame:
        """M5 as of the last micro-batch."""
        return (self.rows().filter(F.col("threat_type") != "normal")
                .groupBy(F.col("ym").alias("period"), F.col("threat_type").alias("thr_cls"),
                         F.col("ip_address").alias("src_addr"))
                .agg(F.sum("events").alias("evt_cnt"), F.sum("passed").alias("succ_cnt"),
                     F.sum("failed").alias("fail_cnt"), F.countDistinct("user_id").alias("tgt_usr"),
                     F.min("first").alias("first_dt"), F.max("last").alias("last_dt")))
