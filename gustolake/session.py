"""SparkSession defaults and the shared scratch location."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. Partition overwrite mode is set
# per write (see sources.io), not globally.
SESSION_DEFAULTS: dict[str, str] = {
    # creation_time_utc is a UTC wall clock; date/hour extraction depends on it
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    # a checkpoint's files go with the last frame that uses them (read when the context starts)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster (hundreds of TB of line items): AQE starts from
# many shuffle partitions and coalesces them to ~256 MB each, scans split into
# 256 MB pieces, and skewed join partitions (> 5x median and > 1 GB) are split.
CLUSTER_DEFAULTS: dict[str, str] = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def build_session(
    master: str | None = None,
    app_name: str = "gustolake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied
    (``cluster=True`` adds the large-cluster sizing)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if cluster:
        conf.update(CLUSTER_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # a reused session keeps its own settings; enforce the ones results depend on
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """Shared folder for materialised intermediates.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system every
    executor can reach). Only when the session names none — local runs and
    tests — a private temporary folder is created and registered.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share; a temporary one is local to a machine")
        base = tempfile.mkdtemp(prefix="gustolake-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    if name is None:
        return base
    return f"{base.rstrip('/')}/{name}"
