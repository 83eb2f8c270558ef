import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shopmarts.operators import layout as L


def rows_read(path, column, low, high):
    """Rows of the row groups whose statistics meet [low, high]."""
    n = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            n += meta.row_group(g).num_rows * (s.min <= high and s.max >= low)
    return n


def test_predicates_on_either_column_skip_files(spark, tmp_path):
    n = 64_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("user"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(720)).alias("day"), "id")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cols = {"user": F.col("user"), "day": F.col("day")}
        L.clustered(df, cols).write.parquet(f"{tmp_path}/z")
        df.repartitionByRange("user", "day").write.parquet(f"{tmp_path}/plain")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows_read(f"{tmp_path}/plain", "day", 100, 129) > 0.9 * n
    assert rows_read(f"{tmp_path}/z", "day", 100, 129) < 0.3 * n
    assert rows_read(f"{tmp_path}/z", "user", 500, 500) < 0.3 * n
    back = spark.read.parquet(f"{tmp_path}/z")
    assert back.exceptAll(df).isEmpty() and back.count() == n
    plan = back.filter("user = 500 AND day BETWEEN 100 AND 129")._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(user,500)" in plan


def test_a_hot_value_spans_partitions_and_nulls_stay(spark):
    df = spark.range(8000).select(
        F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 30 > 0, F.col("id")).alias("user"),
        F.lit(1.5).alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = L.clustered(df, {"user": F.col("user"), "day": F.col("day")})
        hot = out.filter("user = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(hot) >= 4
    assert out.exceptAll(df).isEmpty() and out.count() == 8000
    none = df.limit(0)
    assert L.clustered(none, {"user": F.col("user")}).collect() == []


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a long, b long")
    got = {(r.a, r.b): r.z for r in df.withColumn("z", L.interleaved([F.col("a"), F.col("b")], 2)).collect()}
    assert sorted(got.values()) == list(range(16))
    assert got[1, 0] == 2 and got[0, 1] == 1 and got[3, 3] == 15 and got[2, 0] == 8


def test_sort_keys_are_made_once_a_row(spark):
    df = spark.range(200).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("user"), "id")
    out = L.clustered(df, {"user": F.col("user"), "day": F.col("id") % 7})
    sorts = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines()
             if "Sort [" in line or "RepartitionByExpression" in line]
    assert len(sorts) == 2 and all("_layout_place" in s and "lambda" not in s for s in sorts)
    assert out.columns == df.columns and out.exceptAll(df).isEmpty() and out.count() == 200
