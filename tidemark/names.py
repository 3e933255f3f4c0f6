"""Metric names, in one place for those who write samples and those who read them."""

from __future__ import annotations

# Metric names.
PROCESSED = "consumer_messages_processed_total"
FAILED = "consumer_messages_failed_total"
DEAD_LETTERED = "consumer_dlq_messages_total"
ABNORMAL = "consumer_abnormal_events_total"
LATE = "consumer_late_events_total"
LATENCY_BUCKET = "consumer_processing_seconds_bucket"
WATERMARK_LAG = "consumer_watermark_lag_seconds"
WINDOWS_OPEN = "consumer_windows_open"
WINDOWS_FINALIZED = "consumer_windows_finalized_total"
PARTITION_LAG = "consumer_partition_lag"
DUPLICATES = "consumer_duplicates_ignored_total"
UP = "up"
SINK_UP = "sink_up"
