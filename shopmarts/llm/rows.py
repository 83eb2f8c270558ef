"""Whole rows of a table, kept or repeated by decisions made on narrow ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A top-level column by its exact name."""
    return F.col("`" + name.replace("`", "``") + "`")


def held(df: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``doc``, and ``more`` beside it, so no name
    in ``df`` can clash with one of ours."""
    return df.select(F.struct(*(column(c).alias(c) for c in df.columns)).alias("doc"),
                     *(c.alias(n) for n, c in more.items()))


def released(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names`` of ``doc`` at the top again."""
    return df.select(*(F.col("doc").getField(c).alias(c) for c in names))


def row_key(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed (maps can't)."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return F.xxhash64(*(column(c) for c, k in kinds.items() if "map<" not in k and "variant" not in k))


def one_each(docs: DataFrame, key: Column, chosen: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc, copies``: one row of ``docs`` for each row of ``chosen``.

    ``chosen`` has distinct ``id, key`` (null ids match null ids), ``rows``: how many
    rows of ``docs`` have them, and ``copies``.  Texts are shuffled once, in the
    join.  Only rows that occur more than once are deduplicated, combined before
    their shuffle.
    """
    rows = held(docs, id=column(id_col), key=key).alias("d")
    same = (F.col("d.key") == F.col("c.key")) & F.col("d.id").eqNullSafe(F.col("c.id"))
    out = rows.join(chosen.filter("rows = 1").alias("c"), same).select("doc", "copies")
    again = chosen.filter("rows > 1")
    if not again.isEmpty():
        more = rows.join(again.alias("c"), same).select("doc", "d.key", "d.id", "copies")
        out = out.unionByName(more.dropDuplicates(["key", "id"]).select("doc", "copies"))
    return out
