"""Spark session settings the library relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings the plans assume. Timestamps in the permit model are
# TIMESTAMP_NTZ (Oracle DATE has no zone), but text conversions of zoned
# timestamps (publish times) must not depend on the machine's zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast joins are chosen by Spark only below these measured sizes
    # (file statistics at plan time, shuffle statistics under AQE); beyond
    # them the join stays a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Batch jobs: do not capture a Python call site for every Column function
    # (several driver round trips each while a plan is being built).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Sizing for the production scale (tens of TB per table, ~1000 executors).
# AQE starts every shuffle with many partitions and coalesces them to the
# advisory size measured at run time, so small stages stay small and large
# ones never exceed a few hundred MB per task (no spills of whole groups);
# skewed join partitions above the threshold are split.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "curbwise", cluster: bool = False,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench.

    ``cluster=True`` adds ``CLUSTER_SETTINGS`` for keys the deployment has not
    set itself; ``extra`` are further builder settings (e.g. driver memory of
    a local run, which only applies when this call starts the JVM).
    """
    builder = SparkSession.builder.appName(app_name)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if cluster:
        conf = spark.sparkContext.getConf()
        for k, v in CLUSTER_SETTINGS.items():
            if not conf.contains(k):
                spark.conf.set(k, v)
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory named by the cluster in ``spark.checkpoint.dir``.

    On a cluster this is a shared folder, never overridden, and an error when
    unset. A local master without one (tests) gets a private folder that is
    removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="curbwise-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """One process: ``local``, ``local[4]``; not ``local-cluster[...]`` or a cluster's address."""
    return master == "local" or master.startswith("local[")
