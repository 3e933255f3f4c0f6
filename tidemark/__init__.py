"""tidemark: event-time sensor telemetry on Spark DataFrames.

Operators are functions from DataFrame(s) to DataFrame, built from Spark's own
expressions, joins, windows and micro-batches, and are used unchanged by batch
jobs and by the streaming tick.
"""

from tidemark.policy import EventTimePolicy
from tidemark.session import build_session, ensure_utc

__all__ = ["EventTimePolicy", "build_session", "ensure_utc"]
