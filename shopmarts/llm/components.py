"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.storage import written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node.

    ``edges`` has two columns of one orderable type, in either direction, with
    repeats, self-links and nulls allowed (the last two are dropped).  Returns
    ``node, component``: one row per node that has a link to another node.

    Alternating stars: each round points every node's larger neighbours at its
    smallest one, then does the same with its smaller neighbours, until the
    edges are stars around the smallest node of each component.  Minima are
    combined before the shuffle and joined back, so a node with very many
    links is an ordinary skewed join, never a collected group.  Each round is
    written to the shared folder.
    """
    a, b = edges.columns
    e = written(_ordered(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    before = _state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e = written(_small_star(_large_star(e)), "stars")
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.withColumn("component", F.col("node"))))


def _ordered(e: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``u`` to the smaller node ``v``."""
    return (e.filter(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    e = _ordered(e)
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return _ordered(e.join(low, "u").select("v", "m").unionByName(
        low.select(F.col("u").alias("v"), "m")).toDF("u", "v"))


def _state(e: DataFrame) -> tuple:
    """Row count and order-free checksum of an edge table."""
    h = F.xxhash64("u", "v")
    return tuple(e.agg(F.count("*"), F.sum(F.shiftright(h, 34)), F.bit_xor(h)).first())
