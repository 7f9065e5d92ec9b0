"""SparkSession helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces/splits
# shuffle partitions at runtime; skew-join handling splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "pharmaflow",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the project defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is. Only for a
    ``local`` master (tests) an unset folder becomes a temporary one; elsewhere
    every executor would write to its own disk, so an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors "
                             f"(master {master})")
        path = tempfile.mkdtemp(prefix="pharmaflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "pharmaflow", name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scale_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
               max_partitions: int = 500_000) -> dict:
    """Settings sized from the input: scan splits and shuffle partitions of
    about ``partition_bytes`` each, so a task's data fits executor memory.
    AQE then coalesces small shuffle partitions and splits skewed ones, so
    the initial count only has to be large enough, never exact.

    For 100 TB at 256 MB: about 410k initial shuffle partitions.
    """
    parts = max(1, min(max_partitions, -(-int(input_bytes) // partition_bytes)))
    size = str(partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        # automatic broadcasts stay below a fixed bound whatever the data size
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
