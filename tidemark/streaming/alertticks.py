"""The alert lifecycle as a micro-batch over webhook bodies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.operators import incidents
from tidemark.sources.tables import latest
from tidemark.streaming.tables import TickTable

_COUNTS = T.StructType([
    T.StructField(name, T.LongType())
    for name in ("received_firing", "received_resolved", "persisted", "duplicates_ignored")
])


@dataclass(frozen=True)
class AlertStream:
    """Notification history fed by a stream of (arrival, received_at, body)."""

    root: str

    @property
    def log(self) -> TickTable:
        return TickTable(f"{self.root}/notification_log", schemas.NOTIFICATION)

    @property
    def counts(self) -> TickTable:
        return TickTable(f"{self.root}/alert_counts", _COUNTS)

    def notifications(self, spark: SparkSession) -> DataFrame:
        """The notification table: newest version of every episode."""
        return latest(self.log.read(spark), ["fingerprint", "episode_no"]).drop("tick")

    def process(self, bodies: DataFrame, tick: int) -> None:
        """Handle one micro-batch; safe to repeat.

        The last known episode of each fingerprint joins the batch as an alert
        that arrived before it, so the same transition rules apply.
        """
        spark = bodies.sparkSession
        alerts = self._settle(incidents.parse_alerts(bodies), "alerts")
        known = self.log.before(spark, tick).join(
            alerts.select("fingerprint").distinct(), "fingerprint", "left_semi")
        newest = latest(
            known.withColumn("version", F.struct("episode_no", "tick")), ["fingerprint"], "version"
        )
        carried = newest.select(
            F.lit(-1).cast("bigint").alias("arrival"), F.lit(0).alias("position"),
            F.col("resolved_at").alias("received_at"), "fingerprint", "alert_type", "severity",
            "message", "source", "status", "created_at", "labels",
        )
        tagged = self._settle(incidents.transitions(alerts.unionByName(carried)), "tagged")
        real = F.col("arrival") >= 0
        moved = tagged.where(real & (F.col("transition") != "ignored")).select(
            "fingerprint", "episode_no").distinct()
        changed = incidents.notifications(tagged).join(
            moved, ["fingerprint", "episode_no"], "left_semi")
        # Episodes count on from the last known one, which an open notification is.
        is_open = F.when(F.col("status") == "FIRING", 1).otherwise(0)
        past = newest.select("fingerprint", (F.col("episode_no") - is_open).alias("__past"))
        numbered = changed.join(past, "fingerprint", "left").withColumn(
            "episode_no", F.col("episode_no") + F.coalesce("__past", F.lit(0))
        ).select(*schemas.NOTIFICATION.names)
        self.log.write(numbered, tick)
        self.counts.write(incidents.alert_counters(tagged.where(real)), tick)

    def _settle(self, df: DataFrame, name: str) -> DataFrame:
        """Write a result that several outputs need; each tick overwrites the last one's."""
        path = f"{self.root}/work/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def start(
        self, bodies: DataFrame, checkpoint: str, *, seconds: int | None = 15
    ) -> DataStreamWriter:
        writer = bodies.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", checkpoint)
        if seconds is None:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=f"{seconds} seconds")
