"""Session helpers.

The library never creates data on a machine-local path when running on a
cluster: the checkpoint folder comes from ``spark.checkpoint.dir`` (a shared
folder named by the cluster).  Only local-mode sessions without that setting
(tests, laptops) get a scratch folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "churnkit") -> SparkSession:
    """A local session configured like the tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = builder.config("spark.driver.memory", os.environ.get("CHURNKIT_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it on the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    and the master is local does it fall back to a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="churnkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def scale_settings(input_bytes: int, executor_cores_total: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster run, sized from the input volume.

    Scan splits and shuffle partitions aim at ``partition_bytes`` (256 MB by
    default) so a task's data fits in executor memory without spilling much;
    AQE coalesces small shuffle partitions and splits skewed ones at runtime
    (a partition five times the median and above 1 GB is split).  For 100 TB
    this gives about 400,000 shuffle partitions, i.e. a few hundred waves of
    a 1,000-executor cluster."""
    parts = max(executor_cores_total * 2, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_settings(spark: SparkSession, settings: dict) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)
