"""Continuous evaluation: pass rates per judge over verdict files as they arrive.

The batch operator ``evalstats.pass_rate`` is reused unchanged on a streaming
DataFrame: its counts are streaming aggregates with state kept per judge, so
state size is bounded by the number of judges, never by the number of
verdicts.  Each micro-batch's complete result is a folder of its own; readers take
the newest one that is complete, so neither a reader nor a crash between two
results sees a part.  The checkpoint sits in the shared folder, so a restarted
driver resumes exactly where the stream stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shopmarts.operators import evalstats
from shopmarts.session import remove_path

VERDICT_SCHEMA = "run_id string, trace_id bigint, judge string, verdict string"


def start_pass_rate_monitor(spark: SparkSession, source_dir: str, output_dir: str,
                            checkpoint_dir: str, schema: str | StructType = VERDICT_SCHEMA,
                            files_per_trigger: int = 100,
                            available_now: bool = False) -> StreamingQuery:
    """Start the monitor: parquet verdict files in ``source_dir`` -> per-judge
    pass rates in ``output_dir`` after every micro-batch (see ``latest``)."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))

    def publish(batch: DataFrame, epoch: int) -> None:
        # a repeated epoch replaces its own folder only
        batch.write.mode("overwrite").parquet(f"{output_dir}/epoch={epoch:012d}")
        for old in _epochs(spark, output_dir)[:-2]:      # one is left for slow readers
            remove_path(spark, old)

    w = (evalstats.pass_rate(stream).writeStream
         .outputMode("complete")
         .option("checkpointLocation", checkpoint_dir)
         .foreachBatch(publish))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_until_caught_up(spark: SparkSession, source_dir: str, output_dir: str,
                        checkpoint_dir: str, **kw) -> DataFrame:
    """Process every file present now (in micro-batches), then return the table."""
    q = start_pass_rate_monitor(spark, source_dir, output_dir, checkpoint_dir,
                                available_now=True, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return latest(spark, output_dir)


def _epochs(spark: SparkSession, output_dir: str) -> list[str]:
    """The complete results' folders, oldest first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(output_dir)
    store = top.getFileSystem(conf)
    found = [s.getPath() for s in store.listStatus(top)] if store.exists(top) else []
    done = [p for p in found if p.getName().startswith("epoch=")
            and store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(p.toString() for p in done)


def latest(spark: SparkSession, output_dir: str) -> DataFrame:
    """The newest complete result."""
    done = _epochs(spark, output_dir)
    if not done:
        raise FileNotFoundError(f"no complete result in {output_dir}")
    return spark.read.parquet(done[-1])
