"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults sized for local testing; a cluster launcher overrides them.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# What a cluster launcher should set for this workload (not applied here):
# AQE starts from many shuffle partitions and coalesces them to ~256 MB, so
# the same code fits 60k rows and 100 TB; skewed joins are split at runtime;
# scans cut files into 256 MB splits.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # spark.checkpoint.dir must name a shared folder (e.g. on the cluster FS)
}


def get_session(master: str | None = None, app_name: str = "faultscore", **conf: str) -> SparkSession:
    """Return the active session, or build one with the local defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is.  Only a local-mode session without the setting (tests, the
    bench) gets a fresh temporary folder; a cluster session without it is an
    error, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="faultscore-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
