"""Topics as sources and sinks: a broker where there is one, files elsewhere.

Both carry the same columns, so operators do not know which one feeds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.operators.contract import skip_blank


def source_options(
    servers: str, topic: str, *, starting: str = "earliest", max_per_tick: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for reading a broker topic from the start, in bounded ticks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
        **extra,
    }
    if max_per_tick is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_tick)
    return options


def sink_options(
    servers: str, topic: str, *, compression: str = "gzip", linger_ms: int = 20,
    batch_bytes: int = 65_536, **extra: str,
) -> dict[str, str]:
    """Options for publishing with full acknowledgement, batching and compression."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.compression.type": compression,
        "kafka.linger.ms": str(linger_ms),
        "kafka.batch.size": str(batch_bytes),
        **extra,
    }


def read_topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _columns(spark.readStream.format("kafka").options(**options).load())


def read_topic_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    batch = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return _columns(spark.read.format("kafka").options(**batch).load())


def _columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("key"), "value", "topic", "partition", "offset",
        "timestamp",
    )


def read_topic_files_stream(
    spark: SparkSession, path: str, max_files_per_tick: int | None = None
) -> DataFrame:
    """A topic kept as Parquet files with the same columns as a broker topic."""
    reader = spark.readStream.schema(schemas.TOPIC)
    if max_files_per_tick is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_tick)
    return reader.parquet(path)


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TOPIC).parquet(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON, blank lines skipped."""
    return skip_blank(spark.read.text(path))


def read_json_lines_stream(spark: SparkSession, path: str) -> DataFrame:
    return skip_blank(spark.readStream.text(path))


def to_messages(events: DataFrame, key: str = "customer_id") -> DataFrame:
    """Events as keyed messages with a compact JSON value.

    Keying by customer keeps one customer's events on one partition, in order.
    """
    return events.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(messages: DataFrame, options: dict[str, str]) -> None:
    messages.write.format("kafka").options(**options).save()


def publish_stream(
    messages: DataFrame, options: dict[str, str], checkpoint: str
) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka").options(**options)
        .option("checkpointLocation", checkpoint)
    )


def publish_files(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").parquet(path)
