"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.rows import column, one_each, released
from shopmarts.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1),
                   most: float = 3.0, share: float = 1.0) -> DataFrame:
    """``source, n, source_size, target`` from rows of ``source, size``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight.  With the sources in ascending
    order of cap by weight that has a closed form: before source k the capped
    ones take their caps, and all others get one common rate.  The windows run
    over one row per source.
    """
    s = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(float(w)) for w in weights))
    s = s.withColumn("w", F.get(turn, (F.row_number().over(order) - 1) % len(weights)))
    s = s.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    every = Window.partitionBy()
    # zero-size sources first; ties in a stated order
    by_rate = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_rate.rowsBetween(Window.unboundedPreceding, -1)
    after = by_rate.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(float(share))
    s = s.withColumn("rate", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("w").over(after))
    # the common rate: that of the first source whose cap is not below it; from
    # there on the rates fall
    rate = F.max(F.when(F.col("cap") >= F.col("rate") * F.col("w"), F.col("rate"))).over(every)
    target = F.least(F.col("cap"), F.coalesce(rate, F.lit(float("inf"))) * F.col("w"))
    return s.select("source", "n", "source_size", target.alias("target"))


def inclusion_rates(sizes: DataFrame) -> DataFrame:
    """``source, rate`` from rows of ``source, size, n, extra``: n documents of a size.

    A document of a size is included with probability min(1, rate * sqrt(size)), and
    these probabilities times the sizes add up to the source's ``extra`` words.
    Larger sizes reach 1 first: with sizes descending, those before row k taken as
    certain, the others have one rate; it is right at the first row that it does
    not make certain.  A source without such a row includes everything (no row).
    The window runs over one row per distinct size, of which a source with W words
    has at most sqrt(2 W).
    """
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    before = F.sum(F.col("size") * F.col("n")).over(down.rowsBetween(Window.unboundedPreceding, -1))
    up = Window.partitionBy("source").orderBy("size")
    rest = F.sum(F.sqrt("size") * F.col("size") * F.col("n")).over(
        up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rate = (F.col("extra") - F.coalesce(before, F.lit(0))) / rest
    return (sizes.filter("size > 0").withColumn("rate", rate)
            .filter(F.col("rate") * F.sqrt("size") <= 1)
            .groupBy("source").agg(F.max_by("rate", "size").alias("rate")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0,
        seed: int = 11, per_bucket: int = 512, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``id_col, row_hash, size, source_size, target, copies`` of every row.

    A source whose target is r times its size takes floor(r) certain copies of
    each document.  The rest is a Pareto order sample of a fixed size, counted in
    words.  A document's inclusion probability p grows with the square root of its
    size and reaches 1 for the largest, which are certain; the probabilities times
    the sizes add up to the fixed size (``inclusion_rates``).  Documents are taken in
    ascending order of their random odds u / (1 - u) divided by p / (1 - p).
    u is a hash of the seed, id and text, so reruns agree.

    The order's key falls into about n / ``per_bucket`` buckets a source.
    Buckets below the one that holds the cut are taken whole, by sums made
    before the shuffle, so a hot source stays spread; only the cut's bucket and those
    after it, until they hold ``per_bucket`` rows, are read in order, there taking
    what still fits and in the end the document that comes nearest.  Near the cut
    both odds are alike, so none of these buckets has many more distinct rows than
    ``per_bucket``; equal rows are counted there, not gathered.  A document has at most floor(r) + 1 copies, so never over
    ``most``.  Null and empty texts have size 0 and no copies beyond the certain
    ones; null sources form one source; repeated rows count each, and of some
    that the cut parts any may be taken; an empty table gives an empty result.
    """
    u = (F.shiftrightunsigned(F.col("row_hash"), 11) + 0.5) / float(1 << 53)
    rows = docs.select(
        column(id_col).alias("id"), column(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(column(text_col).cast("string"), F.lit(WORD)), F.lit(0))
        .cast("long").alias("size"), row_hash(seed, id_col, text_col).alias("row_hash"))
    rows = written(rows.withColumn("u", u), "mix_sizes")
    plan = source_targets(rows, weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (plan.withColumn("whole", F.floor(ratio))
            .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
            .withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("n") / per_bucket)))
            .withColumnRenamed("source", "of"))
    plan = written(plan, "mix_sources")
    same = F.col("source").eqNullSafe(F.col("of"))
    rates = inclusion_rates(rows.groupBy("source", "size").agg(F.count("*").alias("n"))
                            .join(plan.select("of", "extra"), same).drop("of"))
    rates = rates.withColumnRenamed("source", "at")
    plan = written(plan.join(rates, F.col("of").eqNullSafe(F.col("at")), "left").drop("at"), "mix_rates")
    chance = F.coalesce(F.col("rate") * F.sqrt("size"), F.lit(1.0))
    rank = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    placed = (rows.join(plan, same)
              .withColumn("p", F.when((F.col("size") > 0) & (F.col("extra") > 0), F.least(chance, F.lit(1.0)))
                          .otherwise(0.0))
              # documents never drawn come last, certain ones before all buckets
              .withColumn("rank", F.when(F.col("p") > 0, rank / (1 + rank)).otherwise(1.0))
              .withColumn("bucket", F.when(F.col("p") == 1, F.lit(-1).cast("long")).otherwise(
                  F.least(F.floor(F.col("rank") * F.col("buckets")), F.col("buckets") - 1))))
    placed = written(placed.drop("of", "n", "buckets", "u", "rate", "p"), "mix_places")
    sums = placed.groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows"), F.first("extra").alias("extra"))
    order = Window.partitionBy("source").orderBy("bucket")
    beyond = (sums.withColumn("upto", F.sum("words").over(order)).filter(F.col("upto") > F.col("extra"))
              .withColumn("read", F.sum("rows").over(order) - F.col("rows")))
    first = F.struct("bucket", (F.col("extra") - F.col("upto") + F.col("words")).alias("gap"))
    cut = (beyond.filter(F.col("read") < per_bucket).groupBy("source")
           .agg(F.min(first).alias("cut"), F.max("bucket").alias("last"))
           .select(F.col("source").alias("of"), F.col("cut.bucket").alias("cut"), "cut.gap", "last"))
    cut = written(cut, "mix_cuts")
    decided = written(placed.join(cut, same, "left"), "mix_decided")
    # without a cut the extra words are all of the source's (or none of zero)
    sure = decided.filter(F.col("cut").isNull() | ~F.col("bucket").between(F.col("cut"), F.col("last"))).withColumn(
        "more", F.when(F.col("cut").isNull() | (F.col("bucket") < F.col("cut")), 1).otherwise(0))
    sure = sure.withColumn("more", F.when(F.col("extra") > 0, F.col("more")).otherwise(0))
    edge = decided.filter(F.col("bucket").between(F.col("cut"), F.col("last")))
    kind = docs.schema[id_col].dataType.simpleString()
    edge = (edge.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
            .groupBy("key", "id", "row_hash", "size", "source_size", "target", "whole", "rank", "gap")
            .agg(F.count("*").alias("rows"))
            .groupBy("key").applyInPandas(
                _fill, f"id {kind}, row_hash long, size long, source_size long, target double, "
                       "whole long, rows long, take long"))
    edge = (edge.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .withColumn("more", (F.col("k") <= F.col("take")).cast("int")))
    names = ["id", "row_hash", "size", "source_size", "target", "whole", "more"]
    out = sure.select(*names).unionByName(edge.select(*names))
    copies = F.col("whole").cast("long") + F.when(F.col("size") > 0, F.col("more")).otherwise(0)
    return out.select(F.col("id").alias(id_col), "row_hash", "size", "source_size", "target",
                      copies.alias("copies"))


def _fill(g: pd.DataFrame) -> pd.DataFrame:
    """How many of each of the cut's ``rows`` equal rows one source takes: in
    order while they fit, then one of the row that leaves the least difference, if
    that is less than the gap."""
    g = g.sort_values(["rank", "row_hash"], kind="stable").reset_index(drop=True)
    gap, take = float(g["gap"].iloc[0]), []
    for size, rows in zip(g["size"], g["rows"]):
        take.append(min(rows, int(gap // size)) if size > 0 else 0)
        gap -= size * take[-1]
    g["take"] = take
    left = g[(g["take"] < g["rows"]) & (g["size"] > 0)]
    if len(left):
        best = (left["size"] - gap).abs().idxmin()
        if abs(left["size"][best] - gap) < gap:
            g.loc[best, "take"] += 1
    return g[["id", "row_hash", "size", "source_size", "target", "whole", "rows", "take"]]


def row_hash(seed: int, id_col: str, text_col: str):
    return F.xxhash64(F.lit(seed), column(id_col), column(text_col))


def apply_mix(docs: DataFrame, mixed: DataFrame, seed: int = 11, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as ``mixed`` takes it; same columns.

    Rows of equal id and text (null ids and texts are equal to each other) are
    counted together: one of them carries the copies of all.  Columns keep their
    names and types whatever they are called; an empty table stays empty.
    """
    take = (mixed.groupBy(F.col(id_col).alias("id"), F.col("row_hash").alias("key"))
            .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0"))
    rows = one_each(docs, row_hash(seed, id_col, text_col), written(take, "mix_copies"), id_col)
    again = rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return released(again, docs.columns)
