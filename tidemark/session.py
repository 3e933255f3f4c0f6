"""Session settings the operators rely on, and shared-folder staging."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    app_name: str = "tidemark", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with UTC, AQE and skew handling on, and the web page off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: text to timestamp conversions assume UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a folder on this machine.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_KEY, None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Used where a result feeds several consumers and is costly to derive (JSON
    decoding): later reads prune columns, and a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
