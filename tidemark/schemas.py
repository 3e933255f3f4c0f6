"""Column layouts of the streams and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_D, _B, _TS = T.DoubleType(), T.BooleanType(), T.TimestampType()
_LABELS = T.MapType(T.StringType(), T.StringType())

# One message of a keyed, partitioned log.
TOPIC = _schema(
    ("key", _S), ("value", T.BinaryType()), ("topic", _S),
    ("partition", _I), ("offset", _L), ("timestamp", _TS),
)

# The raw event table.
RAW = _schema(
    ("event_id", _S), ("customer_id", _S), ("heart_rate", _I), ("event_time", _TS),
    ("ingestion_time", _TS), ("status", _S), ("is_late", _B), ("lateness_seconds", _D),
    ("src_topic", _S), ("src_partition", _I), ("src_offset", _L),
)

# One state of one customer's window.
DAILY = _schema(
    ("customer_id", _S), ("window_start", _TS), ("window_end", _TS),
    ("event_count", _L), ("heart_rate_sum", _L), ("average_heart_rate", _D),
    ("minimum_heart_rate", _I), ("maximum_heart_rate", _I), ("abnormal_count", _L),
    ("finalized_at", _TS), ("is_finalized", _B),
)

DEAD_LETTER = _schema(
    ("original_event", _S), ("error_type", _S), ("error_message", _S),
    ("source_topic", _S), ("source_partition", _I), ("source_offset", _L),
    ("failed_at", _TS), ("dlq_key", _S),
)

ALERT = _schema(
    ("fingerprint", _S), ("alert_type", _S), ("severity", _S), ("message", _S),
    ("source", _S), ("status", _S), ("created_at", _TS), ("labels", _LABELS),
    ("received_at", _TS), ("arrival", _L),
)

NOTIFICATION = _schema(
    ("fingerprint", _S), ("episode_no", _L), ("alert_type", _S), ("severity", _S),
    ("message", _S), ("source", _S), ("status", _S), ("created_at", _TS),
    ("resolved_at", _TS), ("labels", _LABELS),
)

METRIC_SAMPLE = _schema(("ts", _TS), ("name", _S), ("labels", _LABELS), ("value", _D))

LEDGER = _schema(("tick", _L), ("max_event_time", _TS))
