"""The user-facing reports, over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import policy
from tidemark.functions.numbers import round_half_up
from tidemark.operators.dedupe import duplicate_summary
from tidemark.operators.quality import reconcile


def recent_readings(raw: DataFrame, limit: int = 15) -> DataFrame:
    """The latest raw rows by ingestion time, event id breaking ties."""
    return (
        raw.orderBy(F.desc("ingestion_time"), F.desc("event_id"))
        .limit(limit)
        .select(
            "customer_id", "heart_rate", "status", "is_late",
            round_half_up(F.col("lateness_seconds"), 1).cast("double").alias("late_s"),
            "event_time",
        )
    )


def recent_windows(daily: DataFrame, limit: int = 15) -> DataFrame:
    return (
        daily.orderBy(F.desc("window_start"), "customer_id")
        .limit(limit)
        .select(
            "customer_id", "window_start", "event_count",
            round_half_up(F.col("average_heart_rate"), 1).cast("double").alias("avg"),
            F.col("minimum_heart_rate").alias("min"),
            F.col("maximum_heart_rate").alias("max"),
            "abnormal_count", "is_finalized",
        )
    )


def late_summary(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count_if("is_late").alias("late"),
        F.count(F.lit(1)).alias("total"),
        round_half_up(F.max("lateness_seconds"), 1).cast("double").alias("worst_lateness"),
    )


def first_dead_letters(letters: DataFrame, limit: int) -> DataFrame:
    return letters.orderBy("source_partition", "source_offset").limit(limit)


def reconcile_rows(daily: DataFrame, raw: DataFrame, limit: int = 10) -> DataFrame:
    return reconcile(daily, raw).orderBy("customer_id", "window").limit(limit)


def fault_breakdown(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "NORMAL").alias("normal"),
        F.count_if(F.col("status") == "ABNORMAL").alias("abnormal"),
        F.count_if("is_late").alias("late"),
        F.count_if(F.col("lateness_seconds") > policy.EXTREME_LATE_SECONDS).alias("extreme_late"),
        round_half_up(F.max("lateness_seconds"), 0).cast("double").alias("worst_late_s"),
    )


def duplicate_check(raw: DataFrame) -> DataFrame:
    return duplicate_summary(raw)


def recent_notifications(notifications: DataFrame, limit: int = 20) -> DataFrame:
    return (
        notifications.orderBy(F.desc("created_at"), "fingerprint", "episode_no")
        .limit(limit)
        .select("fingerprint", "episode_no", "alert_type", "severity", "status",
                "created_at", "resolved_at")
    )


def notifications_since(notifications: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """History newer than ``days`` at ``as_of``."""
    return notifications.where(
        F.col("created_at") > as_of - F.make_dt_interval(days=F.lit(days))
    ).select("alert_type", "severity", "status", "created_at", "resolved_at")


def notifications_of_type(
    notifications: DataFrame, alert_type: str, start: Column, end: Column
) -> DataFrame:
    return notifications.where(
        (F.col("alert_type") == alert_type)
        & (F.col("created_at") >= start) & (F.col("created_at") < end)
    )
