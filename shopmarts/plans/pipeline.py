"""The medallion pipeline as one runnable plan: raw -> bronze -> silver -> gold
tables, then the semantic-layer comments (S3, S4, S7, S8, S10).

Each layer is written as a table in a database whose files live under one
shared location (the cluster's checkpoint folder when none is given), and the
next layer reads the *written* tables back: lineage is cut at every layer, so a
lost executor only recomputes from the last written layer.  Row counts come
from an ``Observation`` on each write: one job per table, no re-count.

Silver facts are partitioned by month (``ym``) so month-filtered questions
prune files; rows are rebalanced by month before the write (AQE splits a huge
month across tasks), never hash-repartitioned into one task per month.  The
six tables of a layer are independent and are written by concurrent jobs.
"""

from __future__ import annotations

import posixpath
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.operators import marts, silver
from shopmarts.plans import catalog
from shopmarts.session import shared_path
from shopmarts.sources import csvranges, files
from shopmarts.sources.schemas import RAW_SCHEMAS, RAW_TABLES

SILVER_PARTITIONS = {"orders": ["ym"], "sessions": ["ym"], "access_logs": ["ym"]}
COUNT_SCHEMA = "layer string, table_name string, row_count bigint"


def raw_from_csv(spark: SparkSession, src_dir: str, schemas: dict | None = None,
                 keep_corrupt: bool = True, by_ranges: bool = False) -> dict[str, DataFrame]:
    """The six raw CSV files of ``src_dir`` with their explicit schemas
    (the raw-file schemas unless ``schemas`` overrides some of them).

    With ``by_ranges`` a file is read by many tasks, for few large files; else each
    by one.  A malformed row's raw text is kept beside it, for ``quality.rejects``; the
    bronze tables hold only rows that parsed."""
    schemas = {**RAW_SCHEMAS, **(schemas or {})}
    read = csvranges.read_csv_ranges if by_ranges else files.read_csv
    return {t: read(spark, posixpath.join(src_dir, f"{t}.csv"), schemas[t],
                              keep_corrupt=keep_corrupt) for t in RAW_TABLES}


def parsed(raw: DataFrame) -> DataFrame:
    """The rows of a raw table that are well formed, without the raw text."""
    if files.CORRUPT not in raw.columns:
        return raw
    return raw.filter(F.col(files.CORRUPT).isNull()).drop(files.CORRUPT)


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], database: str,
                 location: str | None = None, partition_silver: bool = True,
                 comments: bool = True, user_buckets: int | None = None) -> DataFrame:
    """Write 6 bronze, 6 silver and 6 gold tables; return their row counts.

    With ``user_buckets`` the user-keyed tables (silver_users, gold_customer_rfm,
    gold_user_risk) are bucketed by user id into that many buckets, so later
    joins among them (``customer_360_from_tables``) read co-located buckets
    and need no shuffle."""
    location = location or shared_path(spark, "warehouse", database)
    create_database(spark, database, location)
    counts: list[tuple[str, str, int]] = []

    bucket_keys = {("silver", "users"): "user_id", ("gold", "customer_rfm"): "user_id",
                   ("gold", "user_risk"): "usr_ref"}

    def save(layer: str, name: str, df: DataFrame, partition_by=None):
        table = f"{layer}_{name}"
        key = bucket_keys.get((layer, name)) if user_buckets else None
        n = files.save_table(df, f"{database}.{table}", path=posixpath.join(location, table),
                             partition_by=partition_by,
                             bucket_by=(user_buckets, [key]) if key else None)
        return (layer, name, n)

    def wave(jobs) -> None:
        """The tables of one layer are independent: submit their write jobs
        together so Spark schedules their tasks side by side."""
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            counts.extend(pool.map(lambda j: save(*j), jobs))

    wave([("bronze", t, parsed(raw[t])) for t in RAW_TABLES])
    wave([("silver", t, silver.SILVER[t](spark.table(f"{database}.bronze_{t}")),
           SILVER_PARTITIONS.get(t) if partition_silver else None) for t in RAW_TABLES])

    s = {t: spark.table(f"{database}.silver_{t}") for t in RAW_TABLES}
    orders, logs, users = s["orders"], s["access_logs"], s["users"]
    wave([("gold", "monthly_sales", marts.monthly_sales(orders)),
          ("gold", "customer_rfm", marts.customer_rfm(orders, users)),
          ("gold", "cart_abandonment", marts.cart_abandonment(s["sessions"])),
          ("gold", "access_summary", marts.access_summary(logs)),
          ("gold", "threat_events", marts.threat_events(logs)),
          ("gold", "user_risk", marts.user_risk(logs, users))])
    if comments:
        catalog.apply_comments(spark, database)
    return spark.createDataFrame(counts, COUNT_SCHEMA)


def customer_360_from_tables(spark: SparkSession, database: str) -> DataFrame:
    """Q11 over the written tables; co-located when they were bucketed by user."""
    from shopmarts.operators import questions
    return questions.customer_360(spark.table(f"{database}.silver_users"),
                                  spark.table(f"{database}.gold_customer_rfm"),
                                  spark.table(f"{database}.gold_user_risk"))
