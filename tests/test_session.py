import types

import pytest

from shopmarts import session
from shopmarts.session import scale_conf, shared_path


def test_scale_conf_sizes_partitions_from_input():
    big = scale_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 128 << 20
    small = scale_conf(40 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16            # two tasks per core
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 8 << 20  # floor on split size
    assert int(small["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == (40 << 20) // 32


def test_shared_path_lives_under_the_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    p = shared_path(spark, "x", unique=True)
    assert p.startswith(base) and "/shopmarts/x/" in p


def test_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    sc = types.SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    cluster = types.SimpleNamespace(sparkContext=sc,
                                    conf=types.SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(cluster)
