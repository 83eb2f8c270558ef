from pyspark.sql import functions as F

from shopmarts.session import shared_path
from shopmarts.streaming import monitor as M


def test_monitor_consumes_new_files_incrementally(spark):
    base = shared_path(spark, "test_stream", unique=True)
    rows1 = [("r1", i, "relevance", "pass" if i % 3 else "fail") for i in range(30)]
    rows2 = [("r2", 100 + i, "safety", None if i % 2 else "pass") for i in range(10)]
    spark.createDataFrame(rows1, M.VERDICT_SCHEMA).repartition(3).write.parquet(f"{base}/in/a")
    src = f"{base}/in/*"
    out = M.run_until_caught_up(spark, src, f"{base}/out", f"{base}/ckpt", files_per_trigger=1)
    got = {r.judge: r for r in out.collect()}
    assert (got["relevance"].n, got["relevance"].passed, got["relevance"].failed) == (30, 20, 10)
    # new files arrive: the restarted stream only reads those, state carries over
    spark.createDataFrame(rows2, M.VERDICT_SCHEMA).write.parquet(f"{base}/in/b")
    out = M.run_until_caught_up(spark, src, f"{base}/out", f"{base}/ckpt", files_per_trigger=1)
    got = {r.judge: r for r in out.collect()}
    assert got["relevance"].n == 30
    assert (got["safety"].n, got["safety"].passed, got["safety"].empty,
            got["safety"].pass_pct) == (10, 5, 5, 100.0)
    assert out.filter(F.col("judge").isNull()).count() == 0
