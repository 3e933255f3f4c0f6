"""Backlog of a running query, from the progress the engine reports."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.metrics import backlog


def live_backlog(
    spark: SparkSession, progress: Mapping, log_ends: DataFrame | None = None
) -> DataFrame:
    """(topic, partition, lag) from ``query.lastProgress`` of a topic source.

    ``log_ends`` (topic, partition, end_offset) is where the topic ends, for a source that
    bounds its ticks itself and so reports the end of the tick as its latest offset.
    One entry per topic partition: a handful of numbers.
    """
    ends, positions = [], []
    for source in progress.get("sources", []):
        for target, key in ((ends, "latestOffset"), (positions, "endOffset")):
            offsets = source.get(key) or {}
            offsets = json.loads(offsets) if isinstance(offsets, str) else offsets
            target += [(topic, int(partition), int(offset))
                       for topic, found in offsets.items()
                       for partition, offset in found.items()]
    schema = "topic string, partition int, {} bigint"
    return backlog(
        spark.createDataFrame(ends, schema.format("end_offset")) if log_ends is None else log_ends,
        spark.createDataFrame(positions, schema.format("position")),
    )
