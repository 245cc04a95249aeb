"""Session helpers.

Library code never creates a session of its own; these helpers are for
tests, the bench and command-line use.  Cluster settings (checkpoint
folder, shuffle partitions, AQE) are read from the session when present.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "hirelake") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HIRELAKE_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.conf.set("spark.hirelake.scanTasks", spark.sparkContext.defaultParallelism)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it an error is raised.  Only for a local master (tests) a
    fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="hirelake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cluster_conf(input_bytes: int, *, executors_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings to size a job over ``input_bytes`` of input on a cluster with
    ``executors_cores`` task slots in all (pass them to ``spark-submit --conf``
    or the session builder; nothing here is applied automatically).

    Shuffle partitions start high enough for ~``target_partition_mb`` per
    partition of the largest shuffle (the wide/fact join, about the input
    size) and at least 3 waves of tasks; AQE then coalesces small ones and
    splits skewed ones, and broadcasts only sides it has measured small."""
    per = target_partition_mb * 1024 * 1024
    partitions = max(3 * executors_cores, -(-input_bytes // per))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_partition_mb * 2}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }
