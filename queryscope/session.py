"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every queryscope job relies on.  AQE re-plans joins from runtime
# sizes (the only broadcast decision we leave implicit), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "queryscope", extra: dict | None = None,
                input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Session with the queryscope defaults; pass ``input_bytes`` and
    ``total_cores`` on a cluster to size shuffles with ``scale_conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes and total_cores:
        conf.update(scale_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect
        pass
    return spark


def scale_conf(input_bytes: int, total_cores: int, shuffle_share: float = 0.1,
               target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    Shuffles carry a share of the input (columns are pruned and groups
    combined before them); there are enough partitions for about
    ``target_partition_bytes`` each, but between 2 and 8 per core: map
    tasks times partitions are blocks that the driver tracks.  AQE
    coalesces small partitions and splits skewed join partitions.
    """
    parts = min(8 * total_cores, max(2 * total_cores, -(-int(input_bytes * shuffle_share) // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (HDFS/S3/…) and is only read
    here; without it a job that needs the folder fails.  Only a local
    session (tests) gets a scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="queryscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written intermediate table."""
    return os.path.join(shared_dir(spark), "queryscope", f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path`` (of any file system Spark reaches)?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)
