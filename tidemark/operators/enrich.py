"""Projections on valid and invalid events, and the simple filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import policy
from tidemark.functions import times


def classify(
    heart_rate: Column, low: int = policy.NORMAL_MIN, high: int = policy.NORMAL_MAX
) -> Column:
    """NORMAL inside the band, both ends included; ABNORMAL is still valid data."""
    return F.when(heart_rate.between(low, high), F.lit("NORMAL")).otherwise(F.lit("ABNORMAL"))


def with_status(
    df: DataFrame, low: int = policy.NORMAL_MIN, high: int = policy.NORMAL_MAX
) -> DataFrame:
    return df.withColumn("status", classify(F.col("heart_rate"), low, high))


def stamp(df: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """Fill ingestion time and the flags a row may lack."""
    defaults = {
        "ingestion_time": F.current_timestamp() if ingestion_time is None else ingestion_time,
        "status": F.lit("NORMAL"),
        "is_late": F.lit(False),
    }
    return df.withColumns({
        name: F.coalesce(F.col(name), value) if name in df.columns else value
        for name, value in defaults.items()
    })


def dead_letters(invalid: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Diagnostic envelope around events that failed validation.

    Keyed by customer where the payload names one, by ``unknown`` otherwise.
    """
    return invalid.select(
        F.col("original_event"),
        "error_type",
        "error_message",
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
        F.coalesce(F.col("raw_customer_id"), F.lit("unknown")).alias("dlq_key"),
    )


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    """Dead letters as keyed topic messages; the original event is embedded whole."""
    original = F.try_parse_json("original_event")
    body = F.to_json(
        F.struct(
            F.coalesce(
                original, F.to_variant_object(F.struct("original_event")).cast("variant")
            ).alias("original_event"),
            "error_type", "error_message", "source_topic", "source_partition", "source_offset",
            times.iso_text(F.col("failed_at")).alias("failed_at"),
        )
    )
    return letters.select(F.col("dlq_key").alias("key"), body.alias("value"))


def for_customer(df: DataFrame, customer_id: str) -> DataFrame:
    return df.where(F.col("customer_id") == customer_id)


def in_time_range(df: DataFrame, start: Column, end: Column, column: str = "event_time") -> DataFrame:
    """Rows with ``start <= column < end``."""
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def abnormal_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "ABNORMAL")


def open_only(daily: DataFrame) -> DataFrame:
    return daily.where(~F.col("is_finalized"))


def within_retention(
    df: DataFrame, days: int, as_of: Column | None = None, column: str = "event_time"
) -> DataFrame:
    """Rows not older than ``days`` at ``as_of`` (now by default)."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.where(F.col(column) >= now - F.make_dt_interval(days=F.lit(days)))
