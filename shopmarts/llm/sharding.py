"""Sharding by sampled splitters: ranges of a key, equal in bytes.

DataFrame expressions only; texts are read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.storage import written

#: Bits of the key that come from the text; the rest come from the id.
TEXT_BITS = 40


def record_key(text: Column, row_id: Column) -> Column:
    """A uniform 64-bit key: equal texts are neighbours in key order, and the
    id's bits order (and can divide) a large group of equal texts."""
    low = (1 << (64 - TEXT_BITS)) - 1
    return F.xxhash64(text).bitwiseAND(F.lit(~low)).bitwiseOR(
        F.xxhash64(F.lit(9), row_id).bitwiseAND(F.lit(low)))


def sampled_splitters(rows: DataFrame, total: int, ranges: int, per_range: int = 24) -> list[int]:
    """Keys that cut ``rows`` into about ``ranges`` ranges of equal size.

    Every row enters the sample with a probability in proportion to its size,
    large ones several times: about ``ranges * per_range`` keys, a bound that
    does not grow with the table.  The draw is a hash of the key, so it is
    repeatable.  The splitters are the sample's quantiles.
    """
    share = F.col("size") * F.lit(float(ranges * per_range) / max(1, total))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(23), "key"), 11) + 0.5) / float(1 << 53)
    times = F.floor(share + u).cast("int")
    sample = rows.select("key", times.alias("n")).filter("n > 0").groupBy("key").agg(F.sum("n").alias("n"))
    keys = [(r["key"], r["n"]) for r in sample.orderBy("key").collect()]
    drawn, out, seen = sum(n for _, n in keys), [], 0
    for key, n in keys:
        if (seen + n) * ranges // max(1, drawn) > seen * ranges // max(1, drawn):
            out.append(key)
        seen += n
    return sorted(set(out))


def range_of(key: Column, splitters: list[int], fan: int = 64) -> Column:
    """Number of splitters below ``key``, found in two steps of ``fan``."""
    if not splitters:
        return F.lit(0)
    groups = [splitters[i:i + fan] for i in range(0, len(splitters), fan)]
    longs = lambda v: F.split(F.lit(",".join(map(str, v))), ",").cast("array<bigint>")
    # groups before the key's own, then the splitters below it inside its group
    heads = longs([g[-1] for g in groups])
    own = F.size(F.filter(heads, lambda s: s < key))
    inside = F.split(F.get(F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"),
                           own), ",").cast("array<bigint>")
    return F.when(own == len(groups), F.lit(len(splitters))).otherwise(
        own * fan + F.size(F.filter(inside, lambda s: s < key)))


def shard(docs: DataFrame, shards: int = 8, ranges: int = 2048, rounds: int = 4,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` of every row.

    Size is the text's UTF-8 bytes plus one (null text: one).  Records go into
    ranges of their key between sampled splitters; the ranges' exact sizes are
    added up, and ranges over twice the wanted size are divided by splitters
    sampled inside them, for up to ``rounds`` rounds.  Within a range records
    are ordered by key, id and checksum.  A record's shard is where the middle
    of its bytes falls, so shards are equal in bytes but for one record, and a
    group of equal texts is together unless a shard ends in it.  ``slot``
    numbers a shard's records from 0.  Windows run inside one range, never over
    the table; a range is left large only if one key (equal text and equal id
    bits) is.  Repeated rows are records of their own; null ids and texts are
    allowed; an empty table gives an empty result.  Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
        .alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        record_key(text, F.col(id_col)).alias("key"))
    rows = written(rows, "shard_records")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splitters = sampled_splitters(rows, total, ranges)
    for _ in range(rounds):
        sums = (rows.groupBy(range_of(F.col("key"), splitters).alias("r"))
                .agg(F.sum("size").alias("size"), F.min("key").alias("lo"), F.max("key").alias("hi")))
        full = sums.filter((F.col("size") * ranges > 2 * total) & (F.col("lo") < F.col("hi")))
        full = [r["r"] for r in full.collect()]            # fewer than ranges / 2 of them
        if not full:
            break
        inside = rows.filter(range_of(F.col("key"), splitters).isin(full))
        more = sampled_splitters(inside, total, 4 * ranges, per_range=4)
        if set(more) <= set(splitters):
            break
        splitters = sorted({*splitters, *more})
    placed = rows.withColumn("r", range_of(F.col("key"), splitters))
    sums = placed.groupBy("r").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    starts = written(sums.select(F.col("r").alias("range"), F.coalesce(
        F.sum("bytes").over(before), F.lit(0)).alias("start_byte")), "shard_ranges")
    inner = Window.partitionBy("r").orderBy("key", "id", "crc", "size")
    cum = F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = written(placed.withColumn("upto", cum).withColumn("at", F.row_number().over(inner)),
                     "shard_ranks")
    located = ranked.join(starts, F.col("r") == F.col("range"))
    # twice the middle of the record's bytes, as a share of twice all bytes
    middle = 2 * (F.col("start_byte") + F.col("upto")) - F.col("size")
    own = F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(28,0)") * shards / F.lit(
        2 * max(1, total)).cast("decimal(20,0)")).cast("int"))
    located = written(located.withColumn("shard", own), "shard_places")
    # a record's slot: the shard's records in earlier ranges and before it in its own
    part = located.groupBy("shard", "r").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    part = written(part.select(F.col("shard").alias("s"), F.col("r").alias("range2"), (
        F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")), "shard_slots")
    return (located.join(part, (F.col("r") == F.col("range2")) & (F.col("shard") == F.col("s")))
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("at") + F.col("shift")).cast("long").alias("slot")))
