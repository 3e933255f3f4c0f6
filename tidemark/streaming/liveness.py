"""Metric samples on a clock, so that a stream without messages can be seen to stand still.

Ticks write samples only when there is data. A beat writes what holds between
ticks: that the job is up, how far the watermark lies behind the time of the beat,
how many windows are open, and how far each partition is behind.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark import names, schemas
from tidemark.streaming.progress import live_backlog
from tidemark.streaming.tables import TickTable
from tidemark.streaming.ticks import EventStream

LABELS = {"job": "consumer", "instance": "stream"}


def _map(labels: Mapping[str, str]):
    return F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])


def pulses(stream: EventStream) -> TickTable:
    """The samples of beats; the folder number is the time of the beat in microseconds."""
    return TickTable(f"{stream.root}/pulses", schemas.METRIC_SAMPLE)


def beat(
    spark: SparkSession, stream: EventStream, at: dt.datetime, progress: Mapping | None = None
) -> None:
    """Write the samples of one moment. The same moment again writes the same rows.

    ``progress`` is what the engine reports of the query; without it there is no
    partition lag.
    """
    micros = int(at.timestamp()) * 1_000_000 + at.microsecond
    ts = F.timestamp_micros(F.lit(micros)).alias("ts")
    newest = stream.ledger.read(spark).orderBy(F.desc("tick")).limit(1)
    lag = (F.lit(micros) - F.unix_micros("max_event_time")) / 1e6 + stream.policy.out_of_orderness
    opened = (F.col("windows_opened") - F.col("windows_finalized")).cast("double")

    def sample(name: str, value, labels=None):
        return F.struct(
            ts, F.lit(name).alias("name"),
            (_map(LABELS) if labels is None else labels).alias("labels"), value.alias("value"),
        )

    known = newest.select(F.inline(F.array(
        sample(names.WATERMARK_LAG, lag), sample(names.WINDOWS_OPEN, opened),
    ))).where("value IS NOT NULL")
    rows = known.unionByName(
        spark.range(1, numPartitions=1).select(F.inline(F.array(sample(names.UP, F.lit(1.0))))))
    if progress:
        partition = F.map_concat(_map(LABELS), F.create_map(
            F.lit("partition"), F.col("partition").cast("string")))
        rows = rows.unionByName(live_backlog(spark, progress).select(F.inline(F.array(
            sample(names.PARTITION_LAG, F.col("lag").cast("double"), partition)))))
    pulses(stream).write(rows.coalesce(1), micros)


def beaten(stream: EventStream) -> TickTable:
    """Beats of whole days, one folder a day, named by its first microsecond."""
    return TickTable(f"{stream.root}/pulse_days", schemas.METRIC_SAMPLE)


DAY_MICROS = 86_400 * 1_000_000


def compact_beats(spark: SparkSession, stream: EventStream, before: dt.datetime) -> None:
    """Rewrite the beats of days that ended by ``before`` as one folder a day.

    Readers take a day from there as soon as its folder exists; the beats' own folders
    are then no longer read and may be removed by whoever owns retention. Safe to repeat.
    """
    until = int(before.timestamp()) * 1_000_000 // DAY_MICROS * DAY_MICROS
    day = F.call_function("div", F.col("tick"), F.lit(DAY_MICROS).cast("bigint")) * DAY_MICROS
    old = pulses(stream).read(spark).where(F.col("tick") < until).withColumn("day", day)
    done = beaten(stream).read(spark).select(F.col("tick").alias("day")).distinct()
    days = [r.day for r in old.select("day").distinct().join(done, "day", "left_anti").collect()]  # a row a day
    for first in days:
        one = old.where(F.col("day") == first).select(*schemas.METRIC_SAMPLE.names)
        beaten(stream).write(one.coalesce(1), first)


def samples(spark: SparkSession, stream: EventStream) -> DataFrame:
    """Samples of ticks and beats together."""
    columns = schemas.METRIC_SAMPLE.names
    whole = beaten(stream).read(spark)
    day = F.call_function("div", F.col("tick"), F.lit(DAY_MICROS).cast("bigint")) * DAY_MICROS
    single = pulses(stream).read(spark).withColumn("day", day).join(
        whole.select(F.col("tick").alias("day")).distinct(), "day", "left_anti")
    return stream.samples.read(spark).select(*columns).unionByName(
        whole.select(*columns)).unionByName(single.select(*columns))


class Pulse(StreamingQueryListener):
    """Beats when the query reports progress, and when it reports that it is idle."""

    def __init__(self, spark: SparkSession, stream: EventStream):
        self.spark, self.stream = spark, stream

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        beat(self.spark, self.stream, dt.datetime.now(dt.UTC), json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        beat(self.spark, self.stream, dt.datetime.now(dt.UTC))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        """The forced flush: windows that time has closed are finalized, and a last beat is written."""
        self.stream.flush(self.spark)
        beat(self.spark, self.stream, dt.datetime.now(dt.UTC))
