"""Readings, deliveries and messages derived from the ``events`` table.

``events`` arrives in event-time order, once, and well formed. These mappings
turn every row into a sensor reading and add, as pure functions of the row, the
conditions the operators exist for: backdated readings, redeliveries and
payloads that break the contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import contract
from tidemark.operators.daily import flag_aggregated
from tidemark.operators.dedupe import flag_first_arrivals
from tidemark.operators.enrich import with_status
from tidemark.operators.eventtime import observe, tick_ledger
from tidemark.operators.once import computed_once
from tidemark.policy import EventTimePolicy
from tidemark.session import ensure_utc, scratch_path, stage
from tidemark.sources.stored import StoredTable

SOURCE_PARTITIONS = 3
TICK_DELIVERIES = 500
TOPIC = "heart-rate-events"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def uuid_of(number: Column) -> Column:
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.lower(F.hex(number)), 12, "0"))


def backdate_seconds(number: Column) -> Column:
    """How far a reading's event time lies before its arrival."""
    spread = number * 7919
    return (
        F.when(number % 200 == 0, spread % 172_800)
        .when(number % 20 == 0, spread % 600)
        .otherwise(F.lit(0))
    )


def _reading_columns() -> list[Column]:
    number = F.col("event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return [
        number.alias("seq"),
        uuid_of(number).alias("event_id"),
        F.concat(F.lit("customer-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.floor("value").cast("int").alias("heart_rate"),
        F.timestamp_micros(micros - backdate_seconds(number) * 1_000_000).alias("event_time"),
        F.col("ts").cast("timestamp").alias("sent_at"),
        (F.col("user_id") % SOURCE_PARTITIONS).cast("int").alias("src_partition"),
    ]


def all_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a reading, in or out of the contract's bounds."""
    return events(spark, sf_dir).select(*_reading_columns())


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings within the contract's bounds, delivered once each."""
    return all_readings(spark, sf_dir).where(F.col("heart_rate").between(20, 250))


def _delivered(rows: DataFrame) -> DataFrame:
    """Rows with their arrivals: redelivered ones are emitted twice from one scan."""
    number = F.col("seq")
    delay = F.when(number % 200 == 0, F.lit(3)).otherwise(F.lit(1450))
    first = (number * 2).cast("bigint")
    again = ((number + delay) * 2 + 1).cast("bigint")
    arrivals = F.when(number % 100 == 0, F.array(first, again)).otherwise(F.array(first))
    return rows.withColumn("arrival", F.explode(arrivals))


def deliveries(
    spark: SparkSession, sf_dir: str, tick_deliveries: int = TICK_DELIVERIES
) -> DataFrame:
    """At-least-once deliveries of the valid readings, with arrival and tick."""
    return _delivered(readings(spark, sf_dir)).withColumn(
        "tick", F.call_function("div", F.col("arrival"), F.lit(2 * tick_deliveries))
    )


def ledger_of(rows: DataFrame, policy: EventTimePolicy = EventTimePolicy()) -> DataFrame:
    """The tick ledger, written once: one small row per tick, read several times."""
    return stage(tick_ledger(rows, policy), "ledger")


def tagged(
    spark: SparkSession, sf_dir: str, tick_deliveries: int = TICK_DELIVERIES,
    policy: EventTimePolicy = EventTimePolicy(),
) -> DataFrame:
    """Deliveries with status, lateness, is_new, aggregated and late_outcome."""
    rows = deliveries(spark, sf_dir, tick_deliveries)
    observed = with_status(flag_first_arrivals(observe(rows, policy=policy)))
    return flag_aggregated(observed, policy, ledger_of(rows, policy))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event table: first deliveries with status and lateness."""
    return with_status(
        flag_first_arrivals(observe(deliveries(spark, sf_dir))).where("is_new").drop("is_new")
    ).withColumn("ingestion_time", F.col("sent_at"))


_stored: dict[tuple[str, str, str], StoredTable] = {}


def stored_once(
    spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame], *layout
) -> StoredTable:
    """A table derived from ``sf_dir``, written the first time a session asks for it.

    ``layout`` is the table's time column, date column and key.
    """
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _stored:
        derived = rows()
        table = StoredTable(scratch_path(spark, name), derived.schema, *layout)
        table.write(derived)
        _stored[place] = table
    return _stored[place]


def raw_table(spark: SparkSession, sf_dir: str) -> StoredTable:
    """The raw event table as stored: the reports scan it."""
    return stored_once(
        spark, sf_dir, "raw-table", lambda: raw_events(spark, sf_dir), "event_time", "event_date", ("customer_id",))


FAULTS = 40


def _payload(number: Column) -> Column:
    """JSON text of a reading; some rows break one rule of the contract each."""
    kind = number % FAULTS

    def text_field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

    rate = F.col("heart_rate").cast("string")
    micro_text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    event_id = (
        F.when(kind == 0, text_field("event_id", F.lit("not-a-uuid")))
        .when(kind == 13, text_field(
            "event_id", F.concat(F.lit("{"), F.upper("event_id"), F.lit("}"))))
        .otherwise(text_field("event_id", F.col("event_id")))
    )
    customer = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 5, F.lit('"customer_id":""'))
        .when(kind == 10, F.lit('"customer_id":null'))
        .otherwise(text_field("customer_id", F.col("customer_id")))
    )
    heart_rate = F.concat(F.lit('"heart_rate":'), (
        F.when(kind == 2, F.concat(F.lit('"'), rate, F.lit('"')))
        .when(kind == 6, F.concat(rate, F.lit(".5")))
        .when(kind == 9, F.lit("true"))
        .when(kind == 17, F.concat(rate, F.lit(".0")))
        .otherwise(rate)
    ))
    shifted = F.date_format(
        times.shift_seconds(F.col("event_time"), 3 * 3600), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    )
    event_time = (
        F.when(kind == 11, F.lit(None))
        .when(kind == 4, text_field("event_time", micro_text))
        .when(kind == 12, text_field("event_time", F.lit("not-a-date")))
        .when(kind == 14, text_field("event_time", F.concat(micro_text, F.lit("Z"))))
        .when(kind == 15, text_field("event_time", F.concat(shifted, F.lit("+0300"))))
        .otherwise(text_field("event_time", F.concat(micro_text, F.lit("+00:00"))))
    )
    extra = F.when(kind == 3, F.lit('"firmware_version":"1.2"'))
    body = F.concat(
        F.lit("{"), F.concat_ws(",", event_id, customer, heart_rate, event_time, extra), F.lit("}")
    )
    return (
        F.when(kind == 7, F.regexp_replace(body, r"\}$", ""))
        .when(kind == 8, F.concat(F.lit("["), rate, F.lit("]")))
        .when(kind == 16, F.lit(" \t"))
        .otherwise(body)
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a topic message with a JSON payload."""
    rows = computed_once(
        all_readings(spark, sf_dir), {"value": _payload(F.col("seq")).cast("binary")}
    )
    return rows.select(
        F.col("customer_id").alias("key"),
        "value",
        F.lit(TOPIC).alias("topic"),
        F.col("src_partition").alias("partition"),
        F.col("seq").alias("offset"),
        F.col("sent_at").alias("timestamp"),
    )


def delivered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a message, broken ones included, delivered at least once.

    The broker time gives the order of arrival; offsets are the topic's to give.
    """
    rows = computed_once(
        all_readings(spark, sf_dir), {"value": _payload(F.col("seq")).cast("binary")}
    )
    return _delivered(rows).select(
        F.col("customer_id").alias("key"), "value", F.col("src_partition").alias("partition"),
        F.timestamp_seconds("arrival").alias("timestamp"),
    )


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.validate(contract.decode(contract.skip_blank(messages(spark, sf_dir))))


# A second contract, with choices and an object inside: a device's report.
DEVICE_SCHEMA = {
    "type": "object",
    "additionalProperties": False,
    "required": ["kind", "user", "reading"],
    "properties": {
        "kind": {"type": "string", "enum": ["view", "click", "purchase"]},
        "user": {"type": "integer", "minimum": 0},
        "trusted": {"type": "boolean"},
        "reading": {
            "type": "object",
            "additionalProperties": False,
            "required": ["value", "unit"],
            "properties": {
                "value": {"type": "number", "minimum": 0, "maximum": 400},
                "unit": {"type": "string", "enum": ["bpm", "ms"]},
            },
        },
    },
}


def device_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a device's report; some break one rule of the contract, at either depth."""
    number = F.col("event_id")
    case = number % 16
    reading = (
        F.when(case == 1, F.lit('"reading":{"value":70}'))
        .when(case == 2, F.lit('"reading":{"value":70,"unit":"bpm","extra":1}'))
        .when(case == 3, F.lit('"reading":{"value":"70","unit":"bpm"}'))
        .when(case == 4, F.lit('"reading":{"value":70.5,"unit":"kg"}'))
        .when(case == 5, F.lit('"reading":[70]'))
        .when(case == 6, F.lit(None))
        .when(case == 7, F.lit('"reading":{"value":-3,"unit":"ms"}'))
        .when(case == 8, F.lit('"reading":null'))
        .otherwise(F.concat(F.lit('"reading":{"value":'), (number % 300).cast("string"), F.lit(',"unit":"bpm"}')))
    )
    body = F.concat(F.lit("{"), F.concat_ws(
        ",",
        F.concat(F.lit('"kind":"'), "event_type", F.lit('"')),
        F.concat(F.lit('"user":'), F.when(case == 9, F.lit("true")).otherwise(F.col("user_id").cast("string"))),
        F.when(case == 10, F.lit('"trusted":"yes"')).when(case == 11, F.lit('"trusted":false')),
        reading,
    ), F.lit("}"))
    return events(spark, sf_dir).select(number.alias("offset"), body.cast("binary").alias("value"))
