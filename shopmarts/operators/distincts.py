"""Exact distinct counts that can be merged (A7, A8): bitmaps over dense numbers.

A state holds, for each group, kind of value and block of 32,768 numbers, the
bits of the numbers that occur.  States of any parts of the data are merged by OR
and rolled up to any coarser grouping without reading the data again, and the
number of bits is the exact ``count(DISTINCT ...)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.sources.files import written


def dense_numbers(df: DataFrame, col: str) -> DataFrame:
    """``value, number``: the distinct non-null values of ``col``, numbered from 1
    without gaps.

    Values are numbered inside the partitions that hold them; the partitions'
    counts, one row each, give every partition its first number."""
    place = F.monotonically_increasing_id()
    values = written(
        df.select(F.col(col).alias("value")).filter("value is not null").distinct()
        .select("value", F.shiftright(place, 33).alias("part"),
                place.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "dense_values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (values.groupBy("part").agg(F.count("*").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    return values.join(first, "part").select("value", (F.col("first") + F.col("at") + 1).alias("number"))


def distinct_state(df: DataFrame, keys: list[str], numbers: dict[str, Column]) -> DataFrame:
    """``keys, kind, block, bits``: the numbers of each kind that occur in a group.

    ``numbers`` gives a long for each kind; null ones do not count.  The table is
    read once: every row gives one bit a kind, and bits are combined map-side, so
    a hot group costs a task one row for each block that it has there."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), n.cast("long").alias("n"))
                      for k, n in numbers.items()))
    rows = df.select(*keys, F.inline(kinds)).filter("n is not null")
    return (rows.groupBy(*keys, "kind", F.bitmap_bucket_number("n").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")))


def merged(*states: DataFrame) -> DataFrame:
    """One state of several, of the same keys."""
    union = reduce(DataFrame.unionByName, states)
    keys = [c for c in union.columns if c != "bits"]
    return union.groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, keys: list[str], kinds: list[str]) -> DataFrame:
    """``keys`` and, for each kind, the number of distinct values: the state rolled up
    to ``keys`` (any of its own, or none)."""
    blocks = state.groupBy(*keys, "kind", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    count = F.bitmap_count("bits")
    return blocks.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, count)), F.lit(0))
                                       .alias(k) for k in kinds))


ACCESS_KEYS = ["ym", "threat_type", "time_zone"]


def access_state(access_logs: DataFrame) -> DataFrame:
    """Users and source addresses by month, threat and time band, from one scan of the
    log; addresses are numbered first."""
    sources = dense_numbers(access_logs, "ip_address")
    numbered = access_logs.join(sources, F.col("ip_address") == F.col("value"), "left")
    return distinct_state(numbered, ACCESS_KEYS, {"uniq_usr": F.col("user_id"), "uniq_src": F.col("number")})


def access_rollups(state: DataFrame) -> DataFrame:
    """Distinct users and sources by month and threat, by quarter, by threat and in
    all, from one state."""
    quarter = F.concat(F.substring("ym", 1, 4), F.lit("-Q"),
                       F.ceil(F.substring("ym", 6, 2).cast("int") / 3).cast("string"))
    state = state.withColumns({"quarter": quarter, "all": F.lit("all")})
    kinds = ["uniq_src", "uniq_usr"]
    none = F.lit(None).cast("string")
    levels = [("month and threat", ["ym", "threat_type"], F.col("ym"), F.col("threat_type")),
              ("quarter", ["quarter"], F.col("quarter"), none),
              ("threat", ["threat_type"], none, F.col("threat_type")), ("all", ["all"], none, none)]
    return reduce(DataFrame.unionByName, (
        distinct_counts(state, keys, kinds).select(
            F.lit(name).alias("level"), period.alias("period"), threat.alias("thr_cls"), *kinds)
        for name, keys, period, threat in levels))
