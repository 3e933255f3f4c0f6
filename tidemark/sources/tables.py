"""Stored tables: readers, latest-state views, additive schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_evolved(spark: SparkSession, path: str, defaults: Mapping[str, Column]) -> DataFrame:
    """Read files written before and after columns were added.

    Columns that old files lack are filled with their default; the merged schema
    comes from file footers only.
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df.withColumns({
        name: F.coalesce(F.col(name), value) if name in df.columns else value
        for name, value in defaults.items()
    })


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, column: str, lower: str, upper: str,
    partitions: int, **properties: str,
) -> DataFrame:
    """A database table read in parallel ranges of ``column``."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, **properties,
    ).load()


def latest(log: DataFrame, key: Sequence[str], version: str = "tick") -> DataFrame:
    """The newest row per key of a versioned log that has a key once per version.

    Only keys and versions are aggregated, map-side first, so the rows themselves
    are never sorted by key.
    """
    newest = log.groupBy(*key).agg(F.max(version).alias(version))
    return log.join(newest, [*key, version], "left_semi")


def lookup(state: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows of just the keys in play."""
    return state.join(keys.select(*key).distinct(), list(key), "left_semi")


def by_date(rows: DataFrame, column: str) -> DataFrame:
    """Rows of one date together, so that each date gets few files.

    A rebalance splits a date that holds most of the rows over several tasks.
    """
    return rows.hint("rebalance", F.col(column))


def write_by_date(df: DataFrame, path: str, column: str = "event_time", mode: str = "append") -> None:
    """Store rows under one folder per UTC date, so time ranges prune files."""
    dated = by_date(df.withColumn("event_date", F.to_date(column)), "event_date")
    dated.write.mode(mode).partitionBy("event_date").parquet(path)
