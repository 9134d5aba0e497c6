"""Session defaults and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job of this engine relies on. On a cluster they are passed with
#: ``--conf``; shuffle parallelism is left to AQE, which coalesces from a high start.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # distance kernels and kriging are heavy per byte: keep partitions small enough to use every core
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    # a broadcast table is built in the driver, many times larger than its packed bytes: those that grow with the rows are shuffled
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "dustline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Applies the defaults to a session built elsewhere (all are runtime settings)."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the session has none, a local master (single-machine tests) gets a temporary folder;
    a cluster must name one, as a folder of one machine would lose data with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(configured)
        spark.conf.set("spark.checkpoint.dir", configured)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def written(df, label: str):
    """``df`` written below the shared folder and read again: later uses read columns instead of repeating the work before."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, *keys: str):
    """Hash-partition over every shuffle partition, exempt from AQE coalescing.

    For steps whose work is large for their bytes (distance kernels, dense solves), where
    coalescing by size would leave most cores idle.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
