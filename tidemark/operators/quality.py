"""Table constraints as data-quality checks, and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.functions.text import SEVERITIES
from tidemark.policy import EventTimePolicy


def _between(name: str, low: int, high: int) -> Column:
    return F.col(name).between(low, high)


def raw_rules() -> dict[str, Column]:
    """What must hold on every raw row."""
    return {
        "heart_rate_range": _between("heart_rate", 20, 250),
        "status_values": F.col("status").isin("NORMAL", "ABNORMAL"),
        **not_null("event_id", "customer_id", "heart_rate", "event_time", "status"),
    }


def daily_rules() -> dict[str, Column]:
    return {
        "heart_rate_range": _between("minimum_heart_rate", 20, 250)
        & _between("maximum_heart_rate", 20, 250),
        "minimum_at_most_maximum": F.col("minimum_heart_rate") <= F.col("maximum_heart_rate"),
        "abnormal_at_most_count": F.col("abnormal_count") <= F.col("event_count"),
        **not_null("customer_id", "window_start", "window_end", "event_count"),
    }


def notification_rules() -> dict[str, Column]:
    return {
        "severity_values": F.col("severity").isin(*SEVERITIES),
        "status_values": F.col("status").isin("FIRING", "RESOLVED"),
        "resolved_has_time": (F.col("status") == "RESOLVED") == F.col("resolved_at").isNotNull(),
        **not_null("fingerprint", "alert_type", "message", "created_at"),
    }


def not_null(*names: str) -> dict[str, Column]:
    return {f"{name}_not_null": F.col(name).isNotNull() for name in names}


def check_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations), all rules in one pass. A NULL outcome passes, as in SQL."""
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def check_unique(
    df: DataFrame, key: Sequence[str], rule: str, where: Column | None = None
) -> DataFrame:
    """(rule, violations): surplus rows beyond one per key."""
    rows = df if where is None else df.where(where)
    return (
        rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("violations"))
        .select(F.lit(rule).alias("rule"), "violations")
    )


def check_raw(raw: DataFrame) -> DataFrame:
    return check_rows(raw, raw_rules()).unionByName(
        check_unique(raw, ["event_id"], "event_id_unique")
    )


def check_daily(daily: DataFrame) -> DataFrame:
    return check_rows(daily, daily_rules()).unionByName(
        check_unique(daily, ["customer_id", "window_start"], "window_unique")
    )


def check_notifications(notifications: DataFrame) -> DataFrame:
    return check_rows(notifications, notification_rules()).unionByName(
        check_unique(
            notifications, ["fingerprint"], "one_open_per_fingerprint",
            F.col("status") == "FIRING",
        )
    )


def raw_counts(raw: DataFrame, policy: EventTimePolicy = EventTimePolicy()) -> DataFrame:
    """Raw rows per customer and window."""
    return (
        raw.groupBy(
            "customer_id",
            times.window_start(F.col("event_time"), policy.window).alias("window_start"),
        ).agg(F.count(F.lit(1)).alias("raw"))
    )


def reconcile(
    daily: DataFrame, raw: DataFrame, *, how: str = "inner", open_windows_only: bool = True,
    policy: EventTimePolicy = EventTimePolicy(),
) -> DataFrame:
    """Compare each window's aggregate with its raw count.

    Only open windows can reconcile: a finalized one leaves later events out on
    purpose. ``how='full'`` also shows windows missing on either side; they never
    reconcile.
    """
    side = daily.select("customer_id", "window_start", "is_finalized", "event_count")
    joined = side.join(raw_counts(raw, policy), ["customer_id", "window_start"], how)
    if open_windows_only:
        joined = joined.where(~F.coalesce("is_finalized", F.lit(False)))
    return joined.select(
        "customer_id",
        F.to_date("window_start").alias("window"),
        F.col("event_count").alias("aggregated"),
        "raw",
        F.coalesce(F.col("event_count") == F.col("raw"), F.lit(False)).alias("reconciles"),
    )


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(
        F.count(F.lit(1)).alias("open_windows"),
        F.count_if("reconciles").alias("reconciling"),
    )
