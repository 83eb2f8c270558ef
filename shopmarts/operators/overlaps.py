"""Overlap sweep: how many calls run at once, by trace or by agent (E4).

A call adds one at its start and takes one away at its end.  These signed
endpoints are summed by time before they are shuffled; their running sum is the
number of calls in flight.  It runs over range pieces, so a trace (or agent) with
a large share of all calls spans as many tasks as it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.operators.evalstats import ordered_pieces


def overlap_depths(spans: DataFrame, key: str = "trace_id") -> DataFrame:
    """``key, depth, ms, first_at``: how long exactly ``depth`` calls of a key run at
    once, and when that is first so.  Depth 0 is idle time between calls.

    A call that ends when another starts does not overlap it.  Calls of no length
    take no part, nor do those without a key, start or end, or that end before they
    start.  Repeated calls count each.
    """
    whole = spans.filter(F.col(key).isNotNull() & (F.col("start_ms") < F.col("end_ms")))
    ends = F.array(F.struct(F.col("start_ms").cast("long").alias("at"), F.lit(1).alias("by")),
                   F.struct(F.col("end_ms").cast("long").alias("at"), F.lit(-1).alias("by")))
    steps = (whole.select(key, F.inline(ends)).groupBy(key, "at")
             .agg(F.sum("by").alias("by")).filter("by <> 0"))
    x = ordered_pieces(steps, [key], ["at"], "overlaps")
    local = Window.partitionBy(key, "piece").orderBy("at")
    # one row per key and piece carries the depth in, and the time the next piece begins
    order = Window.partitionBy(key).orderBy("piece")
    carry = (x.groupBy(key, "piece").agg(F.sum("by").alias("s"), F.min("at").alias("first"))
             .select(key, "piece", F.lead("first").over(order).alias("next"),
                     F.coalesce(F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("before")))
    runs = (x.withColumn("depth", F.sum("by").over(local)).withColumn("until", F.lead("at").over(local))
            .join(carry, [key, "piece"])
            .withColumn("depth", F.col("depth") + F.col("before"))
            .withColumn("until", F.coalesce("until", "next")).filter("until IS NOT NULL"))
    return runs.groupBy(key, "depth").agg(F.sum(F.col("until") - F.col("at")).alias("ms"),
                                          F.min("at").alias("first_at"))


def parallelism(depths: DataFrame, key: str = "trace_id") -> DataFrame:
    """Per key: the largest number of calls in flight, when that is first reached,
    and the time with calls, with several calls, and idle between calls."""
    def ms(some):
        return F.coalesce(F.sum(F.when(some, F.col("ms"))), F.lit(0))

    depth = F.col("depth")
    return depths.groupBy(key).agg(
        F.max("depth").alias("peak"), F.max_by("first_at", "depth").alias("peak_at"),
        ms(depth > 0).alias("busy_ms"), ms(depth > 1).alias("parallel_ms"), ms(depth == 0).alias("idle_ms"))
