"""Session helpers.

Library operators never build a session: they take the caller's DataFrames.
``build_session`` is for tests, the bench and command-line use only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed around: AQE re-plans joins from measured
# shuffle sizes (runtime broadcast only below a proven size), splits skewed join
# partitions and rebalanced writes, and coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # ALS shuffles RDDs of factor blocks; Kryo serializes them faster than Java
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def scale_conf(input_bytes: int, executor_cores_total: int,
               target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings sized for a job reading `input_bytes` on `executor_cores_total` cores.

    Shuffle partitions are set so an average partition is about
    `target_partition_bytes` before AQE coalescing (and at least two per core);
    scans split files at the same size; AQE's advisory size and skew threshold
    follow it, so a partition several times larger than the median is split.
    """
    partitions = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "reelstats",
    driver_memory: str = "8g",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and job outputs.

    It is the session's checkpoint directory (``spark.checkpoint.dir``). Only a
    local-mode session without one gets a fresh temporary folder, as in tests;
    a cluster session without one is an error, because a machine-local folder
    is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="reelstats-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root for one job's output."""
    return f"{shared_root(spark).rstrip('/')}/reelstats/{name}-{uuid.uuid4().hex}"
