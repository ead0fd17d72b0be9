"""Spark session with the settings every job in this package assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the analyses rely on; everything else is left to the cluster.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for ~100 TB inputs on a large cluster (profile="cluster"):
# scan splits and shuffle partitions sized so a task holds a few hundred MB,
# AQE coalescing small partitions and splitting skewed ones.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "casebook",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, profile: str | None = None) -> SparkSession:
    """Create (or reuse) a session. ``master`` is only set for local runs;
    ``profile="cluster"`` applies ``CLUSTER_CONF``."""
    b = SparkSession.builder.appName(app)
    if profile == "cluster":
        for k, v in CLUSTER_CONF.items():
            b = b.config(k, v)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("CASEBOOK_DRIVER_MEM", "16g"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem). Only when the setting is absent (local tests) a scratch
    folder is created and registered.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        d = tempfile.mkdtemp(prefix="casebook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
