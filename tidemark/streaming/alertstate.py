"""Notifications as keyed streaming state: one open alert per fingerprint, closed by message or timer.

Webhook bodies are parsed and published by fingerprint, so a fingerprint's alerts are on
one topic partition in order. Each task of a tick reads a contiguous stretch of that
order and folds repeats of the same status into one run before anything is
shuffled; an endlessly repeated alert meets its state as a few runs. The state
(``transformWithState``) holds the last episode of a fingerprint and survives restarts in
the checkpoint. With a timeout, an alert that was not repeated in time is closed by an
event-time timer, at the time at which it ran out. A partition read more slowly than others
may bring a repeat that was in time after all: the alert is then open again, so the
history does not depend on how ticks cut the topic.

Every tick writes the newest version of the episodes it changed to its own folder, so a
replay rewrites the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StreamingQuery

from tidemark import schemas
from tidemark.operators import incidents
from tidemark.sources import segments
from tidemark.sources.tables import latest
from tidemark.streaming.tables import TickTable

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOPIC = "alerts"

#: An alert as it travels; times are microseconds.
_ALERT = "arrival bigint, position int, received_at bigint, fingerprint string, alert_type string, severity string, " \
    "message string, source string, status string, created_at bigint, labels map<string,string>"
_FOLDED = T.StructType([
    *[T.StructField(name, T.StringType()) for name in
      ("fingerprint", "alert_type", "severity", "message", "source", "status")],
    *[T.StructField(name, T.LongType()) for name in
      ("created_at", "offset", "received_at", "repeated_at", "alerts")],
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
])
_STATE = T.StructType([
    T.StructField("episode_no", T.LongType()), T.StructField("is_open", T.BooleanType()),
    T.StructField("ran_out", T.BooleanType()), T.StructField("repeated_at", T.LongType()), T.StructField("created_at", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in ("alert_type", "severity", "message", "source")],
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
])
_OUT = T.StructType([
    T.StructField("fingerprint", T.StringType()), T.StructField("episode_no", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in ("alert_type", "severity", "message", "source", "status")],
    T.StructField("created_at", T.LongType()), T.StructField("resolved_at", T.LongType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
])
_KEPT = ("created_at", "alert_type", "severity", "message", "source", "labels")


def fold(timeout: int | None):
    """Merge an alert into the one before of the same fingerprint and status.

    Works on Arrow batches of alerts in the order of their offsets. ``timeout`` (in
    microseconds) ends a run where a repeat came later than that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("fingerprint").dictionary_encode()
            key = np.asarray(keys.indices if isinstance(keys, pa.DictionaryArray) else keys.combine_chunks().indices)
            firing = np.asarray(batch.column("status").to_pylist(), dtype=object) == "FIRING"
            at = np.asarray(batch.column("received_at"), dtype=np.int64)
            offset = np.asarray(batch.column("offset"), dtype=np.int64)
            order = np.lexsort((offset, key))
            new = np.ones(len(order), dtype=bool)
            k, f, t = key[order], firing[order], at[order]
            new[1:] = (k[1:] != k[:-1]) | (f[1:] != f[:-1])
            if timeout is not None:
                new[1:] |= f[1:] & (t[1:] - t[:-1] > timeout)
            first = np.flatnonzero(new)
            if not len(first):
                continue
            rows = batch.take(pa.array(order[first]))
            last = np.maximum.reduceat(t, first)
            sizes = np.diff(np.append(first, len(order)))
            yield pa.RecordBatch.from_arrays([
                pa.array(last) if name == "repeated_at" else pa.array(sizes) if name == "alerts" else rows.column(name)
                for name in _FOLDED.names
            ], names=_FOLDED.names)

    return run


class Episodes(StatefulProcessor):
    """Opens and closes the notifications of one fingerprint."""

    def __init__(self, timeout: int | None):
        self.timeout = timeout

    def init(self, handle) -> None:
        self.handle = handle
        self.alert = handle.getValueState("alert", _STATE)

    def _row(self, key: str, state: dict, resolved_at: int | None) -> Row:
        return Row(
            fingerprint=key, episode_no=state["episode_no"],
            **{name: state[name] for name in ("alert_type", "severity", "message", "source")},
            status="FIRING" if resolved_at is None else "RESOLVED",
            created_at=state["created_at"], resolved_at=resolved_at, labels=state["labels"],
        )

    def _watch(self, until: int | None) -> None:
        """At most one timer: when the open alert runs out."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if until is not None:
            self.handle.registerTimer(-(-until // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        fingerprint = key[0]
        state = dict(zip(_STATE.names, self.alert.get(), strict=True)) if self.alert.exists() else {
            "episode_no": 0, "is_open": False, "ran_out": False, "repeated_at": None, **dict.fromkeys(_KEPT)}
        changed: dict[int, Row] = {}

        def close(at: int) -> None:
            state["is_open"] = False
            changed[state["episode_no"]] = self._row(fingerprint, state, at)

        for run in sorted(rows, key=lambda r: r.offset):
            if state["ran_out"] and run.received_at <= state["repeated_at"] + self.timeout:
                state["is_open"] = True
                changed[state["episode_no"]] = self._row(fingerprint, state, None)
            state["ran_out"] = False
            if self.timeout is not None and state["is_open"] and run.received_at > state["repeated_at"] + self.timeout:
                close(state["repeated_at"] + self.timeout)
            if run.status != "FIRING":
                if state["is_open"]:
                    close(run.received_at)
            elif state["is_open"]:
                state["repeated_at"] = max(state["repeated_at"], run.repeated_at)
            else:
                state.update({name: run[name] for name in _KEPT})
                state.update(episode_no=state["episode_no"] + 1, is_open=True, repeated_at=run.repeated_at)
                changed[state["episode_no"]] = self._row(fingerprint, state, None)
        self.alert.update(tuple(state[name] for name in _STATE.names))
        if self.timeout is not None:
            self._watch(state["repeated_at"] + self.timeout if state["is_open"] else None)
        yield from changed.values()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if not self.alert.exists():
            return
        state = dict(zip(_STATE.names, self.alert.get(), strict=True))
        if state["is_open"] and (state["repeated_at"] + self.timeout) <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            state.update(is_open=False, ran_out=True)
            self.alert.update(tuple(state[name] for name in _STATE.names))
            yield self._row(key[0], state, state["repeated_at"] + self.timeout)

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class AlertEpisodes:
    """A notification history kept by a stream; ``timeout`` in seconds closes silent alerts."""

    root: str
    timeout: int | None = None
    partitions: int = 3

    @property
    def topic(self) -> str:
        """Parsed alerts, keyed by fingerprint."""
        return f"{self.root}/alerts"

    @property
    def log(self) -> TickTable:
        return TickTable(f"{self.root}/notification_log", schemas.NOTIFICATION)

    def notifications(self, spark: SparkSession) -> DataFrame:
        """The notification table: newest version of every episode."""
        return latest(self.log.read(spark), ["fingerprint", "episode_no"]).drop("tick")

    def publish(self, bodies: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer that parses a stream of (arrival, received_at, body) into the alert topic.

        Parsed alerts are written first, as publishing reads its rows more than once; each tick overwrites the last one's.
        """

        def tick(batch: DataFrame, number: int) -> None:
            alerts = incidents.parse_alerts(batch)
            value = F.struct(
                "arrival", "position", F.unix_micros("received_at").alias("received_at"), "fingerprint", "alert_type",
                "severity", "message", "source", "status", F.unix_micros("created_at").alias("created_at"), "labels",
            )
            keyed = alerts.select(
                F.col("fingerprint").alias("key"), F.to_json(value).cast("binary").alias("value"),
                F.col("received_at").alias("timestamp"), "arrival", "position",
            )
            parsed = f"{self.root}/work/parsed"
            keyed.write.mode("overwrite").parquet(parsed)
            keyed = batch.sparkSession.read.schema(keyed.schema).parquet(parsed)
            segments.publish(
                keyed, self.topic, self.partitions, ["arrival", "position"], writer=checkpoint, batch=str(number))

        return bodies.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)

    def start(
        self, spark: SparkSession, checkpoint: str, *, max_per_tick: int | None = None, seconds: int = 15,
    ) -> StreamingQuery:
        """Follow the alert topic. The state lives in the checkpoint."""
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        gap = None if self.timeout is None else self.timeout * 1_000_000
        read = segments.read_stream(spark, self.topic, TOPIC, max_per_tick)
        # The watermark drives the timers; its column goes no further, so that no alert counts as too late.
        watched = read.withWatermark("timestamp", "0 seconds") if gap is not None else read
        alert = F.from_json(F.col("value").cast("string"), _ALERT).alias("alert")
        runs = watched.select("offset", alert).select("offset", "alert.*").mapInArrow(fold(gap), _FOLDED)
        changes = runs.groupBy("fingerprint").transformWithState(
            statefulProcessor=Episodes(gap), outputStructType=_OUT, outputMode="Update",
            timeMode="None" if gap is None else "EventTime",
        )
        return changes.writeStream.foreachBatch(self._write).outputMode("update").option(
            "checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()

    def _write(self, changes: DataFrame, tick: int) -> None:
        # An alert that comes when its time is already over opens and runs out in one tick: its end counts.
        newest = Window.partitionBy("fingerprint", "episode_no").orderBy(F.desc_nulls_last("resolved_at"))
        one = changes.withColumn("version", F.row_number().over(newest)).where("version = 1")
        named = one.withColumns({
            name: F.timestamp_micros(name) for name in ("created_at", "resolved_at")
        }).select(*schemas.NOTIFICATION.names)
        self.log.write(named, tick)
