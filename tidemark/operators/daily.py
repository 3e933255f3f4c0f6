"""Per-customer tumbling windows: fold, merge, gate and finalize."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators.enrich import classify
from tidemark.operators.eventtime import closing_ticks, tick_ledger
from tidemark.policy import EventTimePolicy

KEY = ("customer_id", "window_start")
MEASURES = (
    "event_count", "heart_rate_sum", "minimum_heart_rate", "maximum_heart_rate", "abnormal_count",
)


def assign_window(df: DataFrame, policy: EventTimePolicy = EventTimePolicy()) -> DataFrame:
    """Add window_start and window_end from the event time."""
    start = times.window_start(F.col("event_time"), policy.window)
    return df.withColumn("window_start", start).withColumn(
        "window_end", times.window_end(F.col("window_start"), policy.window)
    )


def average() -> Column:
    """Derived from sum and count, so that partial states stay mergeable."""
    return F.col("heart_rate_sum") / F.col("event_count")


def fold(df: DataFrame, keys: Sequence[str] = KEY, late: bool = False) -> DataFrame:
    """Reduce readings to one mergeable state per key; ``late`` also counts late rows."""
    abnormal = classify(F.col("heart_rate")) == "ABNORMAL"
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("heart_rate").alias("heart_rate_sum"),
        F.min("heart_rate").alias("minimum_heart_rate"),
        F.max("heart_rate").alias("maximum_heart_rate"),
        F.count_if(abnormal).alias("abnormal_count"),
        *([F.count_if("is_late").alias("late_rows")] if late else []),
    )


def daily_aggregates(
    readings: DataFrame, policy: EventTimePolicy = EventTimePolicy()
) -> DataFrame:
    """Plain batch aggregation: every reading counts, nothing is refused."""
    return present(fold(assign_window(readings, policy)), policy)


def present(states: DataFrame, policy: EventTimePolicy = EventTimePolicy()) -> DataFrame:
    """Add window_end and the average to folded states."""
    return states.withColumn(
        "window_end", times.window_end(F.col("window_start"), policy.window)
    ).withColumn("average_heart_rate", average())


def merge_states(partials: DataFrame, state: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Fold new partial states into the stored state of the keys they touch.

    One row per key of ``partials``; keys only in ``state`` are left alone.
    """
    stored = state.select(*keys, *[F.col(m).alias(f"__{m}") for m in MEASURES])
    combine = {
        "event_count": lambda new, old: new + F.coalesce(old, F.lit(0)),
        "heart_rate_sum": lambda new, old: new + F.coalesce(old, F.lit(0)),
        "minimum_heart_rate": F.least,
        "maximum_heart_rate": F.greatest,
        "abnormal_count": lambda new, old: new + F.coalesce(old, F.lit(0)),
    }
    return partials.join(stored, list(keys), "left").select(
        *keys, *[combine[m](F.col(m), F.col(f"__{m}")).alias(m) for m in MEASURES]
    )


def gate(rows: DataFrame, state: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Add ``accepted``: false where the key's stored window is finalized.

    Only finalized keys are shipped to the join, once each.
    """
    closed = state.where("is_finalized").select(*keys).distinct().withColumn("__closed", F.lit(True))
    return (
        rows.join(closed, list(keys), "left")
        .withColumn("accepted", F.col("__closed").isNull())
        .drop("__closed")
    )


def past_closing(policy: EventTimePolicy, watermark: str = "watermark_before") -> Column:
    """Whether the watermark has passed the window's end plus the lateness."""
    end = times.window_end(F.col("window_start"), policy.window)
    limit = times.shift_seconds(end, policy.allowed_lateness)
    return F.coalesce(F.col(watermark) > limit, F.lit(False))


def per_tick_states(
    new_rows: DataFrame, ledger: DataFrame, policy: EventTimePolicy = EventTimePolicy()
) -> DataFrame:
    """State each tick adds to each window, and whether the window was past closing.

    Rows are folded per (key, tick) before anything is compared along a key, so
    a hot customer is reduced map-side to one row per tick.
    """
    states = fold(assign_window(new_rows, policy), (*KEY, "tick"))
    return states.join(ledger.select("tick", "watermark_before"), "tick").withColumn(
        "past_closing", past_closing(policy)
    )


def daily_by_event_time(
    deliveries: DataFrame, policy: EventTimePolicy = EventTimePolicy(),
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Daily windows under the late-event policy, in closed form.

    ``deliveries`` has every valid delivery with ``tick`` and ``is_new``. A
    window takes new readings until the watermark at the start of a tick lies
    past its end plus the lateness. A window nobody opened before that is opened
    by the first tick that touches it, however old, and closes with that tick.
    Being past closing never reverts, so per key either all states before the
    closing count, or only those of its first tick.
    """
    ledger = tick_ledger(deliveries, policy) if ledger is None else ledger
    states = per_tick_states(deliveries.where("is_new"), ledger, policy)
    open_states = ~F.col("past_closing")

    def over_open(aggregate, measure: str) -> Column:
        return aggregate(F.when(open_states, F.col(measure))).alias(f"__open_{measure}")

    def in_first_tick(measure: str) -> Column:
        return F.min_by(measure, "tick").alias(f"__first_{measure}")

    reduce = dict(zip(MEASURES, (F.sum, F.sum, F.min, F.max, F.sum), strict=True))
    per_key = states.groupBy(*KEY).agg(
        F.min("tick").alias("first_tick"),
        F.min(F.when(open_states, F.col("tick"))).alias("__open_tick"),
        *[over_open(reduce[m], m) for m in MEASURES],
        *[in_first_tick(m) for m in MEASURES],
    )
    opened_late = F.col("__open_tick").isNull()
    windows = per_key.select(
        *KEY,
        "first_tick",
        times.window_end(F.col("window_start"), policy.window).alias("window_end"),
        *[
            F.when(opened_late, F.col(f"__first_{m}")).otherwise(F.col(f"__open_{m}")).alias(m)
            for m in MEASURES
        ],
    )
    # Ends of all delivered readings: a cheap scan, unlike deriving the windows twice.
    ends = assign_window(deliveries, policy).select("window_end")
    closing = closing_ticks(ends, ledger, policy)
    return (
        windows.join(closing, "window_end", "left")
        .withColumn("average_heart_rate", average())
        .withColumn(
            "finalized_tick",
            F.when(F.col("closing_tick").isNotNull(),
                   F.greatest("first_tick", "closing_tick")),
        )
        .withColumn("is_finalized", F.col("finalized_tick").isNotNull())
        .drop("closing_tick")
    )


def flag_aggregated(
    deliveries: DataFrame, policy: EventTimePolicy = EventTimePolicy(),
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Add ``aggregated`` and ``late_outcome`` to every delivery.

    Needs ``tick``, ``is_new`` and ``is_late``. Outcomes: ``on_time``, or for
    late events ``aggregated``, ``finalized`` (raw row only), ``duplicate``.
    """
    ledger = tick_ledger(deliveries, policy) if ledger is None else ledger
    rows = assign_window(deliveries, policy)
    # Windows whose very first tick is already past closing: the only case in
    # which a row past closing counts. One small row per such window.
    opened_late = (
        rows.where("is_new").groupBy(*KEY).agg(F.min("tick").alias("tick"))
        .join(ledger.select("tick", "watermark_before"), "tick")
        .where(past_closing(policy))
        .select(*KEY, "tick")
        .withColumn("__opens", F.lit(True))
    )
    at_start = ledger.select("tick", F.col("watermark_before").alias("__tick_watermark"))
    accepted = F.col("__opens").isNotNull() | ~past_closing(policy, "__tick_watermark")
    return (
        rows.join(at_start, "tick")
        .join(opened_late, [*KEY, "tick"], "left")
        .withColumn("aggregated", F.col("is_new") & accepted)
        .withColumn("late_outcome", late_outcome())
        .drop("__tick_watermark", "__opens")
        .select(*rows.columns, "aggregated", "late_outcome")
    )


def late_outcome() -> Column:
    return (
        F.when(~F.col("is_late"), F.lit("on_time"))
        .when(~F.col("is_new"), F.lit("duplicate"))
        .when(F.col("aggregated"), F.lit("aggregated"))
        .otherwise(F.lit("finalized"))
    )
