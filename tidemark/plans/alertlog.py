"""Webhook bodies derived from ``events``: errors fire, signups resolve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import iso_text
from tidemark.operators.incidents import parse_alerts
from tidemark.plans.readings import events

# Alert names in use; severities and label gaps exercise fallbacks.
ALERT_NAMES = ("ConsumerDown", "DLQRateHigh", "KafkaLagHigh", "WatermarkStuck", "")
SEVERITY_TEXTS = ("CRITICAL", " warning ", "Info", "catastrophic")


def _choice(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _pair(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _alert(number: Column, user: Column, status: Column) -> Column:
    """JSON of one alert about ``user``; optional parts depend on the user."""
    labels = F.concat_ws(
        ",",
        F.when(user % 7 != 6, _pair("alertname", _choice(ALERT_NAMES, user % 5))),
        F.when(user % 11 != 10, _pair("severity", _choice(SEVERITY_TEXTS, user % 4))),
        F.when(user % 3 == 0, _pair("instance", F.concat(F.lit("host-"), user.cast("string")))),
        F.when(user % 3 == 1, _pair("job", F.lit(" worker "))),
        F.when(user % 13 != 12, _pair("service", F.lit("ingest"))),
        _pair("unit", user.cast("string")),
    )
    notes = F.concat_ws(
        ",",
        F.when(user % 2 == 0, _pair("summary", F.lit("  "))),
        F.when(user % 4 < 2, _pair("description", F.concat(F.lit("unit "), user.cast("string")))),
        F.when(user % 6 == 3, _pair("message", F.lit("see runbook"))),
    )
    started = (
        F.when(number % 10 == 9, F.lit(None))
        .when(number % 10 == 8, _pair("startsAt", F.lit("yesterday")))
        .when(number % 10 == 7, _pair("startsAt", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")))
        .otherwise(_pair("startsAt", iso_text(F.col("ts").cast("timestamp"))))
    )
    fields = F.concat_ws(
        ",",
        _pair("status", status),
        F.when(user % 5 != 0, _pair("fingerprint", F.concat(F.lit("fp-"), user.cast("string")))),
        F.concat(F.lit('"labels":{'), labels, F.lit("}")),
        F.when(user % 9 != 8, F.concat(F.lit('"annotations":{'), notes, F.lit("}"))),
        started,
    )
    return F.concat(F.lit("{"), fields, F.lit("}"))


def webhook_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(arrival, received_at, body), one body per event.

    Errors carry one firing alert, signups one resolved, clicks both for two
    users; views carry an entry that is no object, purchases no list at all. Rows are dealt
    anew first: a file with few row groups is read by few tasks, and building and parsing a
    body costs far more than reading its row.
    """
    number, user = F.col("event_id"), F.col("user_id")
    fires, resolves = F.lit("firing"), F.lit("Resolved")
    alerts = (
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("["), _alert(number, user, fires), F.lit("]")))
        .when(F.col("event_type") == "signup",
              F.concat(F.lit("["), _alert(number, user, resolves), F.lit("]")))
        .when(F.col("event_type") == "click",
              F.concat(F.lit("["), _alert(number, user, fires), F.lit(","),
                       _alert(number, user + 1, resolves), F.lit("]")))
        .when(F.col("event_type") == "view",
              F.concat(F.lit("[42,"), _alert(number, user, fires), F.lit("]")))
        .otherwise(F.lit('"none"'))
    )
    body = F.concat(F.lit('{"version":"4","alerts":'), alerts, F.lit("}"))
    dealt = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts").repartition("event_id")
    return dealt.select(
        number.alias("arrival"), F.col("ts").cast("timestamp").alias("received_at"),
        body.alias("body"),
    )


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_alerts(webhook_bodies(spark, sf_dir))
