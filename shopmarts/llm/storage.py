"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopmarts.session import shared_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    Cuts the lineage (a lost executor costs a reread, not a recomputation) and
    keeps several readers from computing ``df`` more than once.
    """
    path = shared_path(df.sparkSession, "llm", label, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
