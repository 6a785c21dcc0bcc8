"""Spark session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Partition counts are left to the cluster: AQE merges small shuffle partitions
# up to the advisory size, so spark.sql.shuffle.partitions only has to be large
# enough for the biggest shuffle of the run.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(master: str | None = None, app: str = "postmill", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    It is the cluster's spark.checkpoint.dir. Where that is unset a folder of our
    own is made, but only for a local master: executors on other machines could
    not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="postmill-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/postmill/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder once and return a frame that reads it back.

    The result survives the loss of executors, is computed once however often it
    is used, and gives Catalyst true file sizes and column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
