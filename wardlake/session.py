"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# The reference's timestamps are UTC ISO-8601 text; every day boundary,
# hour bucket and epoch difference in this library assumes a UTC session.
SESSION_TIME_ZONE = "UTC"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wardlake") -> SparkSession:
    """Build (or reuse) a session with AQE, UTC and the UI switched off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make an existing session usable: UTC zone and a checkpoint folder.

    The checkpoint folder is the cluster's shared ``spark.checkpoint.dir``.
    Only a local master (one machine, as in tests) gets a temporary folder
    when none is configured; any other master raises.
    """
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    base = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="wardlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables,
    stream sinks and stream checkpoints (never a machine-local temp dir when
    the cluster configures a shared one)."""
    base = checkpoint_root(spark).rstrip("/")
    return f"{base}/wardlake/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(executor_cores: int = 4) -> dict[str, str]:
    """Settings for a large cluster (hundreds of executors, ~100 TB input).

    Partitions are sized by bytes, not by count: AQE picks the number of
    post-shuffle partitions from the advisory size and splits skewed ones,
    so the same job fits executor memory at any scale factor.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        # upper bound for the initial shuffle; AQE coalesces down from it
        "spark.sql.shuffle.partitions": "20000",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        # dimensions are broadcast only when Spark's size estimate (and, for
        # the hinted ones, broadcast_if_small's row count) says they are small
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.executor.cores": str(executor_cores),
    }


def cpu_count() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
