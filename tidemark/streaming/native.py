"""The engine's own watermark, for users who accept its late rule.

Unlike the faithful tick, rows behind the watermark are dropped before any
operator can see them again, even when they would open a window nobody has seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators import daily
from tidemark.policy import EventTimePolicy
from tidemark.sources.tables import latest
from tidemark.streaming.tables import TickTable


def with_native_watermark(
    readings: DataFrame, policy: EventTimePolicy = EventTimePolicy()
) -> DataFrame:
    """Declare the engine's watermark; no effect on batch frames."""
    delay = f"{policy.out_of_orderness + policy.allowed_lateness} seconds"
    return readings.withWatermark("event_time", delay)


def native_dedupe(marked: DataFrame) -> DataFrame:
    """Bounded-memory duplicate removal: redeliveries within the watermark delay only."""
    return marked.dropDuplicatesWithinWatermark(["event_id"])


def native_daily(marked: DataFrame, policy: EventTimePolicy = EventTimePolicy()) -> DataFrame:
    """Windowed aggregation of readings with a declared watermark; batch or streaming."""
    keyed = marked.withColumn("window", F.window("event_time", f"{policy.window} seconds"))
    states = daily.fold(keyed, ("customer_id", "window"))
    return states.select(
        "customer_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), *daily.MEASURES,
        daily.average().alias("average_heart_rate"),
    )


def keep_daily(windows: DataFrame, table: TickTable, checkpoint: str) -> DataStreamWriter:
    """A writer that stores, tick by tick, the windows of :func:`native_daily` that changed."""

    def write(changed: DataFrame, tick: int) -> None:
        table.write(changed, tick)

    return windows.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)


def kept_daily(spark: SparkSession, table: TickTable) -> DataFrame:
    """The newest state of every stored window."""
    return latest(table.read(spark), ["customer_id", "window_start"]).drop("tick")
