"""Watermark, lateness and the per-tick watermark ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators.running import blocks_of, running
from tidemark.policy import EventTimePolicy


def observe(
    df: DataFrame,
    *,
    order: Sequence[str] = ("arrival",),
    levels: Sequence[Sequence[Column]] | None = None,
    policy: EventTimePolicy = EventTimePolicy(),
    carry: Column | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add watermark_before, is_late and lateness_seconds to every delivery.

    The watermark is the largest event time among earlier arrivals, less the
    allowed out-of-orderness, so an event is never late relative to itself.
    ``carry`` is the largest event time seen before this frame (an earlier
    tick); ``partition_by`` keeps one watermark per source partition instead of
    a global one. ``lateness_seconds`` is NULL for events on time.
    """
    levels = levels or blocks_of(F.col(order[0]))
    seen = running(
        df, F.col("event_time"), "__max_before",
        order=order, levels=levels, partition_by=partition_by,
    )
    latest = F.col("__max_before")
    if carry is not None:
        latest = F.greatest(latest, carry)
    watermark = F.col("watermark_before")
    return (
        seen.withColumn("watermark_before", times.shift_seconds(latest, -policy.out_of_orderness))
        .withColumn("is_late", times.is_late(F.col("event_time"), watermark))
        .withColumn(
            "lateness_seconds",
            F.when(F.col("is_late"), times.lateness_seconds(F.col("event_time"), watermark)),
        )
        .drop("__max_before")
    )


def tick_ledger(
    df: DataFrame, policy: EventTimePolicy = EventTimePolicy(), tick: str = "tick"
) -> DataFrame:
    """One row per tick: its largest event time, and the watermark around it.

    ``watermark_before`` is what held when the tick started (NULL for the
    first), ``watermark_after`` what holds when it flushes. Every valid delivery
    counts, duplicates included.
    """
    per_tick = df.groupBy(tick).agg(
        F.max("event_time").alias("max_event_time"), F.count(F.lit(1)).alias("deliveries")
    )
    ledger = running(
        per_tick, F.col("max_event_time"), "__before", order=[tick], levels=blocks_of(F.col(tick))
    )
    before = F.col("__before")
    return ledger.select(
        tick,
        "deliveries",
        "max_event_time",
        times.shift_seconds(before, -policy.out_of_orderness).alias("watermark_before"),
        times.shift_seconds(
            F.greatest(before, F.col("max_event_time")), -policy.out_of_orderness
        ).alias("watermark_after"),
    )


def closing_ticks(
    ends: DataFrame, ledger: DataFrame, policy: EventTimePolicy = EventTimePolicy()
) -> DataFrame:
    """For each window end: the first tick that flushes past end + lateness.

    A tick closes every end strictly before ``watermark_after - lateness``, so
    the newest end it closes is a window boundary and the question becomes "the
    first tick of any boundary at or after mine": a running minimum over
    boundaries, which are far fewer than events.
    """
    horizon = times.shift_seconds(F.col("watermark_after"), -policy.allowed_lateness)
    newest = times.window_start(times.shift_seconds(horizon, -1e-6), policy.window)
    boundaries = ledger.groupBy(newest.alias("window_end")).agg(F.min("tick").alias("__tick"))
    wanted = ends.select("window_end").distinct()
    marked = (
        wanted.withColumn("__tick", F.lit(None).cast("bigint"))
        .withColumn("__wanted", F.lit(True))
        .unionByName(boundaries.withColumn("__wanted", F.lit(False)))
        .groupBy("window_end")
        .agg(F.min("__tick").alias("__tick"), F.max("__wanted").alias("__wanted"))
        .withColumn("__rank", -F.unix_micros("window_end"))
    )
    width = policy.window * 1_000_000
    scanned = running(
        marked, F.col("__tick"), "closing_tick", order=["__rank"], how="min", inclusive=True,
        levels=blocks_of(F.call_function("div", F.col("__rank"), F.lit(width).cast("bigint"))),
    )
    return scanned.where("__wanted").select("window_end", "closing_tick")


def watermark_lag(ledger: DataFrame, as_of: Column) -> DataFrame:
    """Seconds the watermark trails ``as_of``, per tick."""
    return ledger.withColumn(
        "watermark_lag_seconds", times.seconds_between(F.col("watermark_after"), as_of)
    )
