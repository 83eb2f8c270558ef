"""Evaluation statistics over agent traces and judge verdicts (E1-E5).

Every statistic is a grouped aggregation with partial (map-side) combine.  The
call profile orders spans by ranges, never a whole trace in one task; exact
percentiles come from counts per distinct duration, summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.functions.buckets import count_when, pct
from shopmarts.sources.files import written


def pass_rate(verdicts: DataFrame) -> DataFrame:
    """E1: per judge: verdicts, pass / fail / empty counts, pass % of judged ones."""
    v = F.col("verdict")
    return (verdicts.groupBy("judge")
            .agg(F.count(F.lit(1)).alias("n"), count_when(v == "pass").alias("passed"),
                 count_when(v == "fail").alias("failed"), count_when(v.isNull()).alias("empty"))
            .withColumn("pass_pct", pct(F.col("passed"), F.col("passed") + F.col("failed"))))


def run_comparison(verdicts: DataFrame, baseline: str | None = None) -> DataFrame:
    """E2: pass % per run and judge, and its change against a baseline run
    (the first run id when none is named)."""
    v = F.col("verdict")
    per = (verdicts.groupBy("run_id", "judge")
           .agg(count_when(v == "pass").alias("passed"), count_when(v == "fail").alias("failed"))
           .withColumn("pass_pct", pct(F.col("passed"), F.col("passed") + F.col("failed"))))
    # the summary has one row per run and judge; the baseline is looked up in it
    judge = Window.partitionBy("judge")
    first_run = F.lit(baseline) if baseline is not None else F.min("run_id").over(Window.partitionBy())
    per = per.withColumn("_base", first_run)
    base = F.max(F.when(F.col("run_id") == F.col("_base"), F.col("pass_pct"))).over(judge)
    return (per.withColumn("baseline_pct", base)
            .withColumn("delta_pct", F.round(F.col("pass_pct") - F.col("baseline_pct"), 1))
            .select("run_id", "judge", "passed", "failed", "pass_pct", "baseline_pct",
                    "delta_pct"))


def _with_duration(spans: DataFrame) -> DataFrame:
    return spans.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))


def slowest_spans(spans: DataFrame) -> DataFrame:
    """The slowest span of every trace (ties: lowest span id), as an aggregation."""
    s = _with_duration(spans)
    key = F.struct(F.col("duration_ms"), (-F.col("span_id")).alias("neg_id"))
    return (s.groupBy("trace_id")
            .agg(F.max_by(F.struct("span_id", "agent", "duration_ms"), key).alias("top"))
            .select("trace_id", F.col("top.span_id").alias("span_id"),
                    F.col("top.agent").alias("agent"), F.col("top.duration_ms").alias("duration_ms")))


def latency_profile(spans: DataFrame) -> DataFrame:
    """E3: per agent: calls, p50 / p95 / max duration, and the share of traces
    whose slowest span is this agent's.

    One pass over the spans gives, per (trace, agent), its calls by duration;
    that summary yields everything else.  A percentile is read off the running
    counts of an agent's distinct durations, interpolated between neighbours;
    those windows run over range pieces of the durations, so no agent's values
    meet in one task."""
    s = _with_duration(spans)
    d = F.col("duration_ms")
    own = written(s.groupBy("trace_id", "agent", "duration_ms").agg(
        F.count(F.lit(1)).alias("n"), F.min("span_id").alias("first_id")), "latency")
    counts = own.groupBy("agent", "duration_ms").agg(F.sum("n").alias("n"))
    pieces = prefix_sums(counts, ["agent"], "duration_ms", "n")
    # one written row per agent, so the join below can be broadcast or split
    per = written(counts.groupBy("agent").agg(F.sum("n").alias("calls"), F.max(d).alias("max_ms")),
                  "latency_totals")
    at = pieces.join(per, "agent")
    for name, q in (("p50", 0.5), ("p95", 0.95)):
        place = F.lit(q) * (F.col("calls") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            # the duration of the call with this rank, counted from 0
            here = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
            at = at.withColumn(f"{name}_{side}", F.when(here, d))
    cuts = at.groupBy("agent").agg(*(F.max(f"{p}_{s}").alias(f"{p}_{s}")
                                     for p in ("p50", "p95") for s in ("lo", "hi")))
    def interpolated(name: str, q: float):
        place = F.lit(q) * (F.col("calls") - 1)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return F.round(low + (place - F.floor(place)) * (high - low), 6)

    key = F.struct(d, (-F.col("first_id")).alias("neg_id"))
    slow = (own.groupBy("trace_id").agg(F.max_by("agent", key).alias("agent"))
            .groupBy("agent").agg(F.count(F.lit(1)).alias("slowest_traces")))
    all_traces = F.sum("slowest_traces").over(Window.partitionBy())   # one row per agent
    slow = slow.withColumn("traces", all_traces)
    total = F.max("traces").over(Window.partitionBy())
    return (per.join(cuts, "agent").join(slow, "agent", "left")
            .withColumn("slowest_traces", F.coalesce("slowest_traces", F.lit(0).cast("long")))
            .withColumn("traces", total)
            .select("agent", "calls", interpolated("p50", 0.5).alias("p50_ms"),
                    interpolated("p95", 0.95).alias("p95_ms"), "max_ms", "slowest_traces",
                    pct(F.col("slowest_traces"), F.col("traces")).alias("slowest_share_pct")))


def ordered_pieces(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` range-partitioned by keys and order, each piece with a number.

    A key with very many rows spans several pieces.  The ranges are written, so
    later readers agree on them."""
    ranged = df.repartitionByRange(*keys, *order).withColumn("piece", F.spark_partition_id())
    return written(ranged, label)


def prefix_sums(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """``df`` with ``upto``, the running sum of ``value`` in each key's order:
    within range pieces, plus the sums of a key's earlier pieces."""
    x = ordered_pieces(df, keys, [order], "prefix")
    inner = Window.partitionBy(*keys, "piece").orderBy(order)
    sums = x.groupBy(*keys, "piece").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, "piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return (x.withColumn("upto", F.sum(value).over(inner)).join(carry, [*keys, "piece"])
            .withColumn("upto", F.col("upto") + F.col("_before")).drop("_before"))


def trace_call_profile(spans: DataFrame) -> DataFrame:
    """E4: for every span: its order in the trace (seq), whether it overlaps an
    earlier call (starts before the running max of earlier ends: parallel), and
    whether it is the trace's slowest (ties: lowest span id).

    Spans are range-partitioned by (trace, start, span): a trace with a large
    share of all spans, or a burst within it, spans as many pieces as it needs.
    Windows run inside a piece; one row per (trace, piece) carries the count,
    the largest end and the slowest span over the pieces."""
    x = ordered_pieces(_with_duration(spans), ["trace_id"], ["start_ms", "span_id"], "spans")
    local = Window.partitionBy("trace_id", "piece").orderBy("start_ms", "span_id")
    within = x.withColumn("lseq", F.row_number().over(local)).withColumn(
        "lprev", F.max("end_ms").over(local.rowsBetween(Window.unboundedPreceding, -1)))
    longest = F.struct(F.col("duration_ms"), (-F.col("span_id")).alias("neg_id"))
    parts = x.groupBy("trace_id", "piece").agg(
        F.count(F.lit(1)).alias("cn"), F.max("end_ms").alias("cmax"), F.max(longest).alias("top"))
    trace = Window.partitionBy("trace_id")
    before = trace.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select("trace_id", "piece",
                         F.coalesce(F.sum("cn").over(before), F.lit(0)).alias("base"),
                         F.max("cmax").over(before).alias("cprev"),
                         (-F.max("top").over(trace)["neg_id"]).alias("slow_id"))
    return (within.join(carry, ["trace_id", "piece"])
            .select("trace_id", "span_id", "agent", "start_ms", "end_ms", "duration_ms",
                    (F.col("base") + F.col("lseq")).cast("int").alias("seq"),
                    F.coalesce(F.col("start_ms") < F.greatest("lprev", "cprev"), F.lit(False))
                     .alias("overlaps_prior"),
                    (F.col("span_id") == F.col("slow_id")).alias("is_slowest")))


def evaluation_dataset(traces: DataFrame, selection: DataFrame, labels: DataFrame,
                       key: str = "trace_id") -> DataFrame:
    """E5: the selected traces with their synced labels (NULL when unlabeled).

    The selection is deduplicated before the semi join (map-side), so a trace
    chosen many times costs one row."""
    return (traces.join(selection.select(key).distinct(), key, "left_semi")
            .join(labels, key, "left"))
