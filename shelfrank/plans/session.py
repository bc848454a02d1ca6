"""Session settings and the checkpoint folder.

The library never builds its own session for a cluster: it receives one. ``build_session`` is for
tests, the benchmark and local runs only.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "shelfrank",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's folder below the shared one that ``spark.checkpoint.dir`` names.

    That setting is used as is. Only a session in one process (``local``, ``local[n]``) without it, as
    in tests, gets a folder of its own; any cluster session without it (``local-cluster`` too) is an
    error, because a machine-local folder is not seen by other executors.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
            configured = tempfile.mkdtemp(prefix="shelfrank-ckpt-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cluster_settings(input_bytes: float, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a run over ``input_bytes`` of parquet on a cluster (pass them to the
    builder or spark-submit). Shuffle partitions start at about input / 256 MB, at least 3 waves of
    tasks, so a partition fits an executor core's memory share even before AQE merges small ones;
    AQE then coalesces toward the advisory size and splits skewed partitions (a key with a third of
    the rows is split across tasks for joins; aggregations and top-k windows combine map-side)."""
    slots = max(1, executors * cores_per_executor)
    parts = max(3 * slots, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # Broadcast only what AQE has measured below 64 MB; never by file-size estimates of big inputs.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.session.timeZone": "UTC",
    }
