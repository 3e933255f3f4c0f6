"""Webhook bodies to typed alerts, and alerts to a FIRING/RESOLVED history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text, times
from tidemark.operators.once import computed_once
from tidemark.operators.running import blocks_of, running

ORDER = ("arrival", "position")

_NAIVE_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"


def alert_time(raw: Column, fallback: Column) -> Column:
    """RFC-3339 text as an instant; naive text is UTC; anything else is ``fallback``."""
    naive = F.when(raw.rlike(_NAIVE_ISO), raw.try_cast("timestamp"))
    return F.coalesce(times.parse_iso_with_offset(raw), naive, fallback)


def parse_alerts(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One typed row per alert in each webhook body.

    ``bodies`` has arrival (BIGINT, unique), received_at and the JSON text. A
    body whose ``alerts`` is not a list yields nothing, and entries that are not
    objects are skipped.
    """
    alert = F.col("alert")
    labels, notes = F.col("labels"), F.col("annotations")

    def field(name: str) -> Column:
        return F.try_variant_get(alert, f"$.{name}", "string")

    def mapping(name: str) -> Column:
        found = F.try_variant_get(alert, f"$.{name}", "map<string,string>")
        return F.coalesce(found, F.create_map().cast("map<string,string>"))

    entries = F.try_variant_get(F.try_parse_json(body), "$.alerts", "array<variant>")
    found = computed_once(bodies, {"__entries": entries}).select(
        "arrival", "received_at", F.posexplode("__entries").alias("position", "alert")
    ).where(F.schema_of_variant(alert).startswith("OBJECT"))
    found = computed_once(found, {
        "labels": mapping("labels"), "annotations": mapping("annotations"),
        **{f"__{name}": field(name) for name in ("fingerprint", "status", "startsAt")},
    })
    return found.select(
        "arrival", "position", "received_at",
        F.coalesce(
            F.when(F.col("__fingerprint") != "", F.col("__fingerprint")),
            text.label_fingerprint(labels),
        ).alias("fingerprint"),
        text.alert_type(labels["alertname"]).alias("alert_type"),
        text.severity(labels["severity"]).alias("severity"),
        text.alert_message(notes, labels).alias("message"),
        text.alert_source(labels).alias("source"),
        text.alert_status(F.col("__status")).alias("status"),
        alert_time(F.col("__startsAt"), F.col("received_at")).alias("created_at"),
        labels,
    )


def transitions(
    alerts: DataFrame, order: Sequence[str] = ORDER, levels: Sequence[Sequence[Column]] | None = None
) -> DataFrame:
    """Add ``transition``: opened, closed or ignored, and the running episode_no.

    FIRING opens a notification unless one is open, RESOLVED closes the open one.
    Only the status of the preceding alert of the same fingerprint matters, and
    it is found block by block, so one endlessly repeated alert is no hot spot.
    """
    levels = levels or blocks_of(F.col(order[0]))
    columns = alerts.columns
    state = F.struct(*order, "status")
    seen = running(
        alerts, state, "__previous", order=order, levels=levels, partition_by=["fingerprint"]
    )
    firing = F.col("status") == "FIRING"
    was_open = F.coalesce(F.col("__previous.status") == "FIRING", F.lit(False))
    tagged = seen.withColumn(
        "transition",
        F.when(firing & ~was_open, F.lit("opened"))
        .when(~firing & was_open, F.lit("closed"))
        .otherwise(F.lit("ignored")),
    ).drop("__previous")
    opened = F.when(F.col("transition") == "opened", F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return running(
        tagged, opened, "episode_no", order=order, levels=levels, how="sum",
        partition_by=["fingerprint"], inclusive=True,
    ).select(*columns, "transition", "episode_no")


def notifications(tagged: DataFrame) -> DataFrame:
    """One row per episode, from alerts tagged by :func:`transitions`.

    ``created_at`` is the alert's own start, ``resolved_at`` the time the
    resolving alert was received.
    """
    opened, closed = F.col("transition") == "opened", F.col("transition") == "closed"

    def opening(name: str) -> Column:
        # Exactly one row opens an episode.
        return F.any_value(F.when(opened, F.col(name)), True).alias(name)

    episodes = tagged.where(opened | closed).groupBy("fingerprint", "episode_no").agg(
        *[opening(n) for n in ("alert_type", "severity", "message", "source", "created_at",
                               "labels")],
        F.max(F.when(closed, F.col("received_at"))).alias("resolved_at"),
    )
    status = F.when(F.col("resolved_at").isNotNull(), F.lit("RESOLVED")).otherwise(F.lit("FIRING"))
    return episodes.select(
        "fingerprint", "episode_no", "alert_type", "severity", "message", "source",
        status.alias("status"), "created_at", "resolved_at", "labels",
    )


def notification_history(
    alerts: DataFrame, order: Sequence[str] = ORDER,
    levels: Sequence[Sequence[Column]] | None = None,
) -> DataFrame:
    return notifications(transitions(alerts, order, levels))


def open_new(alerts: DataFrame, open_notifications: DataFrame) -> DataFrame:
    """First FIRING alert per fingerprint that has no open notification."""
    fresh = alerts.where(F.col("status") == "FIRING").join(
        open_notifications.select("fingerprint"), "fingerprint", "left_anti"
    )
    firsts = fresh.groupBy("fingerprint").agg(F.min(F.struct(*ORDER)).alias("__first"))
    return fresh.join(
        firsts.select("fingerprint", "__first.*"), ["fingerprint", *ORDER], "left_semi"
    )


def close_open(resolving: DataFrame, open_notifications: DataFrame) -> DataFrame:
    """Open notifications closed by the first RESOLVED alert of their fingerprint."""
    closing = resolving.where(F.col("status") == "RESOLVED").groupBy("fingerprint").agg(
        F.min("received_at").alias("__resolved_at")
    )
    return (
        open_notifications.join(closing, "fingerprint")
        .withColumn("resolved_at", F.col("__resolved_at"))
        .withColumn("status", F.lit("RESOLVED"))
        .select(*open_notifications.columns)
    )


def alert_counters(tagged: DataFrame) -> DataFrame:
    """Alerts received by status, persisted, and ignored as repeats."""
    return tagged.agg(
        F.count_if(F.col("status") == "FIRING").alias("received_firing"),
        F.count_if(F.col("status") == "RESOLVED").alias("received_resolved"),
        F.count_if(F.col("transition") != "ignored").alias("persisted"),
        F.count_if(F.col("transition") == "ignored").alias("duplicates_ignored"),
    )
