"""Session construction and shared scratch folders.

Scratch data (stream sources, sinks, written tables, checkpoints) always lives
under the shared folder named by ``spark.checkpoint.dir``.  Only when that is
unset *and* the master is local (tests, laptops) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "eventide") -> SparkSession:
    """A local session (tests, benchmarks); clusters use ``cluster_session``."""
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("EVENTIDE_SESSION_TZ", "UTC"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


TARGET_PARTITION_BYTES = 256 << 20   # advisory size of a shuffle partition after AQE
SCAN_SPLIT_BYTES = 512 << 20         # file bytes per scan task (columns are pruned inside)
SHUFFLE_BYTES_PER_INPUT_PARTITION = 1 << 30
MAX_SHUFFLE_PARTITIONS = 100_000     # map statuses grow with mappers x reducers


def cluster_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """SQL settings sized for the stored input of a job on a large cluster.

    Scans read only the projected columns and partial aggregation shrinks
    what is shuffled, so shuffles start at one partition per GB of stored
    input (at least two waves of the cluster's cores, at most 100,000); AQE
    coalesces them to the advisory size, splits skewed join partitions and
    oversized REBALANCE partitions (partitioned writes).  Broadcasts stay
    small and fixed, by size in bytes; larger sides are shuffled.
    """
    parts = -(-input_bytes // SHUFFLE_BYTES_PER_INPUT_PARTITION)
    parts = min(MAX_SHUFFLE_PARTITIONS, max(2 * total_cores, parts))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def cluster_session(input_bytes: int, app: str = "eventide") -> SparkSession:
    """Session on the cluster the job was submitted to.

    The settings of ``cluster_settings`` apply only where the cluster's own
    configuration leaves them unset; ``spark.checkpoint.dir`` must name shared
    storage (``checkpoint_root`` refuses a machine-local fallback).
    """
    spark = SparkSession.builder.appName(app).getOrCreate()
    sc = spark.sparkContext
    cores = sc.defaultParallelism
    given = sc.getConf()
    for key, value in cluster_settings(input_bytes, cores).items():
        if not given.contains(key):
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    On a cluster this must already be set to shared storage; we refuse to fall
    back to a machine-local folder there.  In local mode (tests) we set one.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/eventide/{name}-{uuid.uuid4().hex[:12]}"
