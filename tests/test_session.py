"""Session helpers: shared folder comes from the cluster setting; shuffle sizing rule."""

import pytest

from queryscope.session import scale_conf, shared_dir, shared_path


def test_shared_dir_reads_existing_setting(spark):
    d = spark.conf.get("spark.checkpoint.dir")
    assert d and shared_dir(spark) == d
    assert shared_path(spark, "x").startswith(d.rstrip("/") + "/queryscope/x-")


def test_scale_conf_partitions():
    conf = scale_conf(100 << 40, total_cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == str((100 << 40) // 10 // (256 << 20))   # 10 TB shuffled: 40,960
    assert scale_conf(100 << 40, total_cores=1000)["spark.sql.shuffle.partitions"] == "8000"   # no more than 8 a core
    assert scale_conf(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"] == "16"
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


class _Session:
    """A session on a cluster without the setting."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "yarn"}.get(key, default)


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session())
