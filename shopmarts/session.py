"""Session and shared-storage helpers."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "shopmarts", conf: dict | None = None) -> SparkSession:
    """Local/test session builder.  On a cluster, use the session you are given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where there is none (e.g. Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A cluster must set it.  Only a local master (tests, one machine) gets a
    folder of its own when it is unset; elsewhere an unset folder is an error,
    because a machine-local folder is invisible to the other executors.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver "
                               f"and all executors share (master: {master or 'unknown'})")
        d = "file://" + tempfile.mkdtemp(prefix="shopmarts-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "0") or 0) or int(
        spark.conf.get("spark.sql.shuffle.partitions", "200"))


def num_partitions(df) -> int | None:
    """Input partition count of a DataFrame, when the API exposes it."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:
        return None


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (visible to every executor).

    The folder's scheme is kept, so the path means the same to Spark whatever
    the default filesystem is; Spark's writers create the folders."""
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return posixpath.join(ensure_checkpoint_dir(spark), "shopmarts", *tail)


def scale_conf(input_bytes: int, total_cores: int, target_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a run over ``input_bytes`` of input on ``total_cores``.

    Scan splits and shuffle partitions aim at ``target_bytes`` each (so a task's
    working set fits executor memory and spills stay small), never fewer than
    two tasks per core; AQE then coalesces small shuffle partitions and splits
    skewed ones at runtime.  E.g. 100 TB on 8,000 cores: 256 MB splits and
    ~400k shuffle partitions before coalescing."""
    parts = max(2 * total_cores, -(-input_bytes // target_bytes))
    split = max(8 << 20, min(target_bytes, -(-input_bytes // (2 * total_cores))))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(
            min(target_bytes // 2, max(1 << 20, input_bytes // (4 * total_cores)))),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_bytes),
    }


def remove_path(spark: SparkSession, path: str) -> bool:
    """Best-effort recursive delete of an intermediate folder we wrote (any
    Hadoop-compatible filesystem).  Returns False where it cannot (e.g. no JVM
    gateway, as under Spark Connect); leftovers are then only disk, not results."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
    except Exception:
        return False
