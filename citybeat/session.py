"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # iterative jobs checkpoint every round: drop a round's files once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "citybeat") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    The operators only rely on ``spark.sql.session.timeZone=UTC`` (calendar
    parts are computed in UTC, as the reference does).  Everything else is
    sizing that a cluster deployment sets in its own configuration.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # Local mode runs every task in the driver JVM.
        builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, executor_cores: int, executor_memory_gb: float) -> dict[str, str]:
    """Shuffle / scan sizing for a cluster run over ``input_bytes`` of Parquet.

    Scan splits of 512 MB; an initial shuffle width giving ~128 MB per
    partition of the largest shuffle (bounded by what one core's share of
    executor memory can sort without heavy spilling), which AQE then coalesces
    towards 256 MB and splits again where a key is skewed.  At 100 TB this
    gives ~800k initial shuffle partitions before coalescing.
    """
    per_core = executor_memory_gb * 1024**3 / max(1, executor_cores)
    target = int(min(128 * 1024**2, per_core / 4))
    partitions = max(200, input_bytes // max(1, target))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * 1024**2),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024**2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024**2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024**2),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (local tests) a folder under the system temp dir is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"citybeat-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (never machine-local)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/citybeat-{name}-{uuid.uuid4().hex[:12]}"
