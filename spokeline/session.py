"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Adaptive execution splits a hot day when tables are written (see
    # sinks.tables) and merges small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def builder(app_name: str = "spokeline") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that are written and read back.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder of
    this machine is used only by a local session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="spokeline-")
