"""Clustered layout over several columns: predicates on any of them skip files (S3).

Sorting by (a, b) lets only predicates on ``a`` skip files.  Here the ranks of all
columns are interleaved bit by bit, and rows are range-partitioned and sorted by
the interleaved number, so every file and row group is narrow in each column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.sources.files import written


def interleaved(ranks: list[Column], bits: int) -> Column:
    """One long from the lowest ``bits`` of each rank, highest bits first in turn."""
    parts = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")),
                         b * len(ranks) + len(ranks) - 1 - k)
             for k, r in enumerate(ranks) for b in range(bits)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def rank_cuts(df: DataFrame, columns: dict[str, Column], bits: int) -> dict[str, list]:
    """For each column the values that divide its rows into 2^bits like shares: at
    most 2^bits - 1 numbers a column, from one aggregation."""
    shares = F.array(*(F.lit(k / 2 ** bits) for k in range(1, 2 ** bits)))
    row = df.agg(*(F.percentile_approx(c, shares, 10000).alias(n) for n, c in columns.items())).first()
    return {n: sorted(set(row[n] or [])) for n in columns}


def _rank(value: Column, cuts: list) -> Column:
    """How many of the cuts are not above the value; 0 for null."""
    if not cuts:
        return F.lit(0)
    below = F.filter(F.array(*(F.lit(v) for v in cuts)), lambda cut: cut <= value)
    return F.when(value.isNull(), 0).otherwise(F.size(below))


def clustered(df: DataFrame, columns: dict[str, Column], bits: int = 6) -> DataFrame:
    """``df`` range-partitioned and sorted by the interleaved ranks of ``columns``
    (name: a number made of the row; times as days or seconds).

    At most 62 / number of columns ``bits`` are used.  Rows of one rank are divided
    further by the columns and a hash of the row, so a value that a third of all rows
    hold still spans many partitions.  Nulls rank first; an empty table stays empty.
    The sort keys are columns of the row while it moves: made once a row, not once a
    comparison.
    """
    bits = min(bits, 62 // len(columns))
    cuts = rank_cuts(df, columns, bits)
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    values, ranks = ({n: f"_layout_{kind}_{n}" for n in columns} for kind in ("value", "rank"))
    keyed = (df.withColumns({values[n]: c for n, c in columns.items()})
             .withColumns({ranks[n]: _rank(F.col(values[n]), cuts[n]).cast("long") for n in columns})
             .withColumns({"_layout_place": interleaved([F.col(r) for r in ranks.values()], bits),
                           "_layout_hash": F.xxhash64(*hashed)})
             .drop(*ranks.values()))
    order = ["_layout_place", *values.values(), "_layout_hash"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)


def rewritten(df: DataFrame, columns: dict[str, Column], label: str = "clustered") -> DataFrame:
    """``df`` written in its clustered layout and read back: same rows."""
    return written(clustered(df, columns), label)
