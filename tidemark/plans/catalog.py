"""Every registered query: (spark, sf_dir) -> DataFrame over the whole tables.

Instants leave as TIMESTAMP_NTZ in UTC, the way the input table stores them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import times
from tidemark.operators import alerts as A
from tidemark.operators import contract, daily, dedupe, enrich, eventtime, incidents, quality
from tidemark.operators import metrics as M
from tidemark.operators.running import blocks_of, running
from tidemark.plans import alertlog, readings, reports, telemetry
from tidemark.policy import EventTimePolicy
from tidemark.session import scratch_path, stage
from tidemark.sources import segments, tables
from tidemark.sources.stored import StoredTable
from tidemark.sources.topics import to_messages
from tidemark.streaming.alertstate import AlertEpisodes
from tidemark.streaming.native import keep_daily, kept_daily, native_daily, with_native_watermark
from tidemark.streaming.ruleticks import RuleStream, sample_message, samples_of
from tidemark.streaming.tables import TickTable
from tidemark.streaming.ticks import EventStream

Query = Callable[[SparkSession, str], DataFrame]

# Settings of the derived inputs, scaled to their ten-minute scrapes.
SHORT, LONG, LOOKBACK = 1800, 3600, 1800
RULES = tuple(
    A.Rule(r.name, r.severity, r.component, hold)
    for r, hold in zip(A.RULES, (600, 600, 1200, 1800, 1800, 2400), strict=True)
)
LIMITS = {
    "lag_limit": 10_000, "latency_limit": 4.5, "share_limit": 0.3617, "watermark_limit": 600,
}


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, doubles rounded to nine digits."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 9)
        out.append(column.alias(field.name))
    return df.select(*out)


_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(function(spark, sf_dir))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- Readings and contract -------------------------------------------------------


@query
def daily_aggregates(spark, sf_dir):
    """Readings folded per customer and UTC day."""
    return daily.daily_aggregates(readings.readings(spark, sf_dir)).select(
        "customer_id", "window_start", "window_end", "event_count", "heart_rate_sum",
        "average_heart_rate", "minimum_heart_rate", "maximum_heart_rate", "abnormal_count",
    )


@query
def classified_readings(spark, sf_dir):
    """Every reading with its status and UTC day window."""
    rows = daily.assign_window(enrich.with_status(readings.all_readings(spark, sf_dir)))
    return rows.select("event_id", "customer_id", "heart_rate", "status", "event_time",
                       "window_start", "window_end")


@query
def contract_outcomes(spark, sf_dir):
    """Validity, error type and full error text of every message."""
    return readings.validated(spark, sf_dir).select(
        "offset", "is_valid", "error_type", "error_message"
    )


@query
def device_contract(spark, sf_dir):
    """Outcomes under a second schema document, with choices and an inner object."""
    device = contract.from_schema(readings.DEVICE_SCHEMA)
    checked = contract.validate(contract.decode(readings.device_reports(spark, sf_dir)), device)
    return checked.select(
        "offset", "is_valid", "error_message", "kind", "user", "trusted", "reading_value", "reading_unit")


@query
def valid_readings(spark, sf_dir):
    """Typed, canonical readings of the messages that pass the contract."""
    valid, _ = contract.split(readings.validated(spark, sf_dir))
    return enrich.with_status(contract.to_readings(valid)).select(
        "event_id", "customer_id", "heart_rate", "event_time", "status",
        "src_topic", "src_partition", "src_offset",
    )


def _dead_letters(spark, sf_dir):
    _, invalid = contract.split(readings.validated(spark, sf_dir))
    return enrich.dead_letters(invalid, failed_at=F.col("timestamp"))


@query
def dead_letters(spark, sf_dir):
    """Envelope around every invalid message, keyed for the dead-letter topic."""
    return _dead_letters(spark, sf_dir).select(
        F.length("original_event").cast("bigint").alias("original_length"),
        "error_type", "error_message", "source_topic", "source_partition", "source_offset",
        "failed_at", "dlq_key",
    )


@query
def dead_letter_head(spark, sf_dir):
    """The first dead letters in partition and offset order."""
    return reports.first_dead_letters(_dead_letters(spark, sf_dir), 25).select(
        "source_partition", "source_offset", "error_type", "error_message", "dlq_key"
    )


@query
def dead_letters_by_error(spark, sf_dir):
    """Processed and dead-lettered messages per failure kind and partition."""
    return M.count_by(
        readings.validated(spark, sf_dir), M.failure_counters(), by=["partition"]
    )


@query
def dead_letter_retention(spark, sf_dir):
    """Dead letters younger than a week at the newest message."""
    letters = _dead_letters(spark, sf_dir)
    newest = readings.messages(spark, sf_dir).agg(F.max("timestamp")).scalar()
    return enrich.within_retention(letters, 7, newest, "failed_at").select(
        "source_partition", "source_offset", "failed_at"
    )


@query
def messages_by_key(spark, sf_dir):
    """Valid readings as keyed JSON messages, counted per key with their sizes."""
    rows = readings.readings(spark, sf_dir).select(
        "event_id", "customer_id", "heart_rate",
        times.iso_text(F.col("event_time")).alias("event_time"),
    )
    return to_messages(rows).groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.length("value")).cast("bigint").alias("characters"),
        F.min("value").alias("first_value"), F.max("value").alias("last_value"),
    )


# -- Event time --------------------------------------------------------------------


@query
def lateness(spark, sf_dir):
    """Watermark before, late flag and lateness of every delivery."""
    return eventtime.observe(readings.deliveries(spark, sf_dir)).select(
        "arrival", "event_id", "event_time", "watermark_before", "is_late", "lateness_seconds"
    )


@query
def lateness_per_partition(spark, sf_dir):
    """The same with one watermark per source partition."""
    return eventtime.observe(
        readings.deliveries(spark, sf_dir), partition_by=["src_partition"]
    ).select("arrival", "src_partition", "watermark_before", "is_late", "lateness_seconds")


@query
def watermark_ledger(spark, sf_dir):
    """Largest event time and watermark of every tick."""
    return eventtime.tick_ledger(readings.deliveries(spark, sf_dir))


@query
def watermark_lag(spark, sf_dir):
    """How far the watermark trails the last arrival of each tick."""
    rows = readings.deliveries(spark, sf_dir)
    ends = rows.groupBy("tick").agg(F.max("sent_at").alias("as_of"))
    ledger = eventtime.tick_ledger(rows).join(ends, "tick")
    return eventtime.watermark_lag(ledger, F.col("as_of")).select(
        "tick", "watermark_after", "watermark_lag_seconds"
    )


@query
def first_arrivals(spark, sf_dir):
    """is_new on every delivery: first arrival of its id."""
    return dedupe.flag_first_arrivals(readings.deliveries(spark, sf_dir)).select(
        "arrival", "event_id", "is_new"
    )


@query
def deduplicated(spark, sf_dir):
    """First deliveries only, per customer."""
    kept = dedupe.keep_first_arrivals(readings.deliveries(spark, sf_dir))
    return kept.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("events"), F.max("arrival").alias("last_arrival")
    )


def _halves(spark, sf_dir):
    rows = readings.deliveries(spark, sf_dir)
    middle = rows.agg(F.call_function("div", F.max("arrival"), F.lit(2))).scalar()
    return rows.where(F.col("arrival") <= middle), rows.where(F.col("arrival") > middle)


@query
def insert_if_absent(spark, sf_dir):
    """Later half of the deliveries against ids stored from the earlier half."""
    stored, batch = _halves(spark, sf_dir)
    return dedupe.insert_if_absent(batch, dedupe.keep_first_arrivals(stored)).select(
        "arrival", "event_id", "is_new"
    )


@query
def merged_state(spark, sf_dir):
    """Stored states of the earlier half merged with the later half's new readings."""
    stored_rows, batch = _halves(spark, sf_dir)
    stored = dedupe.keep_first_arrivals(stored_rows)
    fresh = dedupe.insert_if_absent(batch, stored).where("is_new")
    states = daily.fold(daily.assign_window(stored))
    partials = daily.fold(daily.assign_window(fresh))
    return daily.merge_states(partials, states).withColumn("average_heart_rate", daily.average())


@query
def delivery_outcomes(spark, sf_dir):
    """The whole late-event policy per delivery."""
    return readings.tagged(spark, sf_dir).select(
        "arrival", "event_id", "tick", "status", "is_late", "lateness_seconds", "is_new",
        "aggregated", "late_outcome",
    )


def _daily(spark, sf_dir, tick_deliveries=readings.TICK_DELIVERIES, policy=EventTimePolicy()):
    rows = readings.deliveries(spark, sf_dir, tick_deliveries)
    ledger = readings.ledger_of(rows, policy)
    return daily.daily_by_event_time(dedupe.flag_first_arrivals(rows), policy, ledger)


@query
def daily_by_event_time(spark, sf_dir):
    """Daily windows under the late-event policy, with their finalizing tick."""
    return _daily(spark, sf_dir).select(
        "customer_id", "window_start", "event_count", "heart_rate_sum", "average_heart_rate",
        "minimum_heart_rate", "maximum_heart_rate", "abnormal_count", "first_tick",
        "finalized_tick", "is_finalized",
    )


@query
def daily_flush_every_event(spark, sf_dir):
    """The same with a flush after every single delivery and no allowed lateness."""
    return _daily(spark, sf_dir, 1, EventTimePolicy(allowed_lateness=0)).select(
        "customer_id", "window_start", "event_count", "heart_rate_sum", "is_finalized"
    )


@query
def hourly_by_event_time(spark, sf_dir):
    """One-hour windows: the width is a parameter."""
    return _daily(spark, sf_dir, policy=EventTimePolicy(window=3600, allowed_lateness=600)).select(
        "customer_id", "window_start", "window_end", "event_count", "finalized_tick"
    )


@query
def finalized_gate(spark, sf_dir):
    """Raw rows by whether their stored window is already finalized."""
    rows = daily.assign_window(readings.deliveries(spark, sf_dir))
    gated = daily.gate(rows, _daily(spark, sf_dir))
    return gated.groupBy("accepted").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(*daily.KEY).alias("windows")
    )


@query
def window_gauges(spark, sf_dir):
    """Open and finalized windows after every tick."""
    windows = stage(_daily(spark, sf_dir), "daily")
    opened = windows.groupBy(F.col("first_tick").alias("tick")).agg(
        F.count(F.lit(1)).alias("opened")
    )
    closed = windows.where("is_finalized").groupBy(F.col("finalized_tick").alias("tick")).agg(
        F.count(F.lit(1)).alias("finalized")
    )
    per_tick = opened.join(closed, "tick", "full").select(
        "tick", F.coalesce("opened", F.lit(0)).alias("opened"),
        F.coalesce("finalized", F.lit(0)).alias("finalized"),
    )
    still = running(
        per_tick, F.col("opened") - F.col("finalized"), "windows_open", order=["tick"],
        levels=blocks_of(F.col("tick")), how="sum", inclusive=True,
    )
    return still.select("tick", "opened", "finalized", "windows_open")


@query
def native_watermark_daily(spark, sf_dir):
    """Daily windows by the engine's own window function and watermark."""
    return native_daily(with_native_watermark(readings.readings(spark, sf_dir))).select(
        "customer_id", "window_start", "window_end", "event_count", "average_heart_rate",
        "minimum_heart_rate", "maximum_heart_rate", "abnormal_count",
    )


STREAM_TICKS = 4


def _stream_messages(spark, sf_dir):
    """Valid deliveries as topic messages."""
    rows = readings.deliveries(spark, sf_dir)
    body = F.to_json(F.struct(
        "event_id", "customer_id", "heart_rate", times.iso_text(F.col("event_time"))
        .alias("event_time"),
    ))
    return rows.select(
        F.col("customer_id").alias("key"), body.cast("binary").alias("value"),
        F.col("src_partition").alias("partition"), F.timestamp_seconds("arrival").alias("timestamp"),
    )


def _run_stream(spark, messages):
    """Messages published to a partitioned topic and drained by a streaming query in bounded ticks."""
    stream = EventStream(scratch_path(spark, "stream"))
    topic = scratch_path(spark, "stream-topic")
    segments.publish(messages, topic, readings.SOURCE_PARTITIONS)
    ends = segments.TopicLog(topic).ends()
    share = -(-max(ends.values(), default=1) // STREAM_TICKS)
    read = segments.read_stream(spark, topic, readings.TOPIC, share * max(1, len(ends)))
    running_query = stream.start(read, scratch_path(spark, "stream-checkpoint"), seconds=0).start()
    try:
        running_query.processAllAvailable()
    finally:
        running_query.stop()
    return stream


@query
def stream_native_daily(spark, sf_dir):
    """Daily windows of a streaming aggregation under the engine's own watermark, late rows dropped."""
    topic = scratch_path(spark, "native-topic")
    segments.publish(_stream_messages(spark, sf_dir), topic, readings.SOURCE_PARTITIONS)
    ends = segments.TopicLog(topic).ends()
    share = -(-max(ends.values(), default=1) // STREAM_TICKS)
    messages = segments.read_stream(spark, topic, readings.TOPIC, share * max(1, len(ends)))
    valid, _ = contract.split(contract.validate(contract.decode(messages)))
    windows = native_daily(with_native_watermark(contract.to_readings(valid)))
    table = TickTable(scratch_path(spark, "native-daily"), windows.schema)
    running_query = keep_daily(windows, table, scratch_path(spark, "native-checkpoint")).start()
    try:
        running_query.processAllAvailable()
    finally:
        running_query.stop()
    return kept_daily(spark, table)


@query
def stream_daily(spark, sf_dir):
    """The daily table after running all deliveries through the streaming tick."""
    return _run_stream(spark, _stream_messages(spark, sf_dir)).daily(spark).select(
        "customer_id", "window_start", "window_end", "event_count", "heart_rate_sum",
        "average_heart_rate", "minimum_heart_rate", "maximum_heart_rate", "abnormal_count",
        "is_finalized",
    )


@query
def stream_raw(spark, sf_dir):
    """The raw table the streaming tick stores."""
    return _run_stream(spark, _stream_messages(spark, sf_dir)).raw.read(spark).select(
        "event_id", "customer_id", "heart_rate", "event_time", "status", "is_late",
        "lateness_seconds", "tick",
    )


def _event_path(spark, sf_dir):
    """The whole event path over every row of the table, broken messages included."""
    return _run_stream(spark, readings.delivered_messages(spark, sf_dir))


@query
def event_path_raw(spark, sf_dir):
    """The raw table after message, contract, watermark and dedupe, from all messages."""
    return _event_path(spark, sf_dir).raw.read(spark).select(
        "event_id", "customer_id", "heart_rate", "event_time", "status", "is_late",
        "lateness_seconds", "src_topic", "src_partition", "src_offset", "tick",
    )


@query
def event_path_daily(spark, sf_dir):
    """The daily table from all messages."""
    return _event_path(spark, sf_dir).daily(spark).select(
        "customer_id", "window_start", "window_end", "event_count", "heart_rate_sum",
        "average_heart_rate", "minimum_heart_rate", "maximum_heart_rate", "abnormal_count",
        "is_finalized",
    )


@query
def event_path_dead_letters(spark, sf_dir):
    """The dead letters of all messages."""
    return _event_path(spark, sf_dir).dead_letters.read(spark).select(
        F.length("original_event").cast("bigint").alias("original_length"), "error_type",
        "error_message", "source_topic", "source_partition", "source_offset", "dlq_key", "tick",
    )


def _alert_stream(spark, sf_dir, timeout=None):
    """All webhook bodies through the alert topic and the keyed state, in three bounded ticks."""
    stream = AlertEpisodes(scratch_path(spark, "alerts"), timeout)
    bodies = stage(alertlog.webhook_bodies(spark, sf_dir), "bodies")
    arriving = spark.readStream.schema(bodies.schema).parquet(bodies.inputFiles()[0].rpartition("/")[0])
    stream.publish(arriving, scratch_path(spark, "alerts-in")).trigger(availableNow=True).start().awaitTermination()
    ends = segments.TopicLog(stream.topic).ends()
    share = -(-max(ends.values(), default=1) // 3)
    running_query = stream.start(
        spark, scratch_path(spark, "alerts-state"), max_per_tick=share * max(1, len(ends)), seconds=0)
    try:
        running_query.processAllAvailable()
    finally:
        running_query.stop()
    return stream


@query
def stream_notifications(spark, sf_dir):
    """The notification table that a stream with keyed state keeps of all webhook bodies."""
    return _alert_stream(spark, sf_dir).notifications(spark).drop("labels")


SILENCE = 6 * 3600


@query
def stream_auto_resolved(spark, sf_dir):
    """The same stream, where timers close alerts that were not repeated for six hours."""
    return _alert_stream(spark, sf_dir, SILENCE).notifications(spark).drop("labels")


# -- Reports ---------------------------------------------------------------------------


def _raw(spark, sf_dir):
    """The stored raw table."""
    return readings.raw_table(spark, sf_dir).read(spark)


def _windows(spark, sf_dir):
    """The stored daily table: one row per customer and window."""
    return readings.stored_once(
        spark, sf_dir, "daily-table", lambda: _daily(spark, sf_dir), "window_start", "window_date", ("customer_id",))


@query
def recent_readings(spark, sf_dir):
    return reports.recent_readings(_raw(spark, sf_dir))


@query
def recent_windows(spark, sf_dir):
    return reports.recent_windows(_windows(spark, sf_dir).read(spark))


@query
def late_summary(spark, sf_dir):
    return reports.late_summary(_raw(spark, sf_dir))


@query
def reconcile_windows(spark, sf_dir):
    """Open windows against their raw counts, first ten customers."""
    return reports.reconcile_rows(_windows(spark, sf_dir).read(spark), _raw(spark, sf_dir))


@query
def reconcile_summary(spark, sf_dir):
    return quality.reconcile_summary(
        quality.reconcile(_windows(spark, sf_dir).read(spark), _raw(spark, sf_dir))
    )


@query
def reconcile_all(spark, sf_dir):
    """Every window, open or not, with windows missing on either side shown."""
    return quality.reconcile(
        _windows(spark, sf_dir).read(spark), _raw(spark, sf_dir), how="full",
        open_windows_only=False,
    )


@query
def fault_breakdown(spark, sf_dir):
    return reports.fault_breakdown(_raw(spark, sf_dir))


@query
def duplicate_check(spark, sf_dir):
    """Stored rows, distinct ids and surplus, for deliveries and for the raw table."""
    return reports.duplicate_check(readings.deliveries(spark, sf_dir)).withColumn(
        "table_name", F.lit("deliveries")
    ).unionByName(
        reports.duplicate_check(_raw(spark, sf_dir)).withColumn(
            "table_name", F.lit("raw")
        )
    )


@query
def duplicate_estimate(spark, sf_dir):
    """Distinct ids of all deliveries from one sketch per tick, against the exact count."""
    rows = readings.deliveries(spark, sf_dir)
    sketches = stage(dedupe.distinct_sketches(rows, ["tick"]), "id-sketches")
    exact = dedupe.duplicate_summary(rows)
    off = F.abs(F.col("estimate") - F.col("distinct_ids")) / F.greatest("distinct_ids", F.lit(1))
    return dedupe.united(sketches).withColumn("all", F.lit(1)).join(exact.withColumn("all", F.lit(1)), "all").select(
        F.col("rows").alias("stored"), "distinct_ids", (off <= dedupe.SKETCH_ERROR).alias("within_error"))


@query
def evolved_windows(spark, sf_dir):
    """The daily table with files from before and after a column was added with a default."""
    rows = _windows(spark, sf_dir).read(spark)
    before = StoredTable(
        scratch_path(spark, "evolved"), rows.select("customer_id", "window_start", "event_count").schema,
        "window_start", "window_date", ("customer_id",))
    before.write(rows.where(F.col("event_count") % 2 == 0))
    after = before.with_column("is_finalized", T.BooleanType(), "false").with_column("source", T.StringType(), "'import'")
    after.write(rows.where(F.col("event_count") % 2 == 1).withColumn("source", F.lit("stream")))
    return after.read(spark).select("customer_id", "window_start", "event_count", "is_finalized", "source")


@query
def delivery_counters(spark, sf_dir):
    """Processed, abnormal, duplicate and late counters per tick."""
    return M.count_by(readings.tagged(spark, sf_dir), M.delivery_counters(), by=["tick"])


@query
def customer_history(spark, sf_dir):
    """One customer's readings in event-time order."""
    raw = _raw(spark, sf_dir)
    return enrich.for_customer(raw, "customer-7").orderBy("event_time").select(
        "event_id", "heart_rate", "status", "event_time", "is_late"
    )


@query
def customer_windows(spark, sf_dir):
    """One customer's daily windows in order."""
    return enrich.for_customer(_windows(spark, sf_dir).read(spark), "customer-7").orderBy(
        "window_start"
    ).select("window_start", "event_count", "average_heart_rate", "is_finalized")


@query
def abnormal_in_range(spark, sf_dir):
    """Abnormal readings of ten days, per customer."""
    rows = readings.raw_table(spark, sf_dir).between(
        spark, F.timestamp_micros(F.lit(1704844800000000)), F.timestamp_micros(F.lit(1705708800000000)))
    return enrich.abnormal_only(rows).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("abnormal"), F.max("heart_rate").alias("highest")
    )


@query
def raw_retention(spark, sf_dir):
    """Raw rows of the last seven days at the newest event."""
    raw = _raw(spark, sf_dir)
    newest = readings.readings(spark, sf_dir).agg(F.max("event_time")).scalar()
    kept = enrich.within_retention(raw, 7, newest)
    return kept.groupBy("status").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_time").alias("oldest")
    )


@query
def raw_checks(spark, sf_dir):
    """Constraint violations of the deliveries, as if they were the raw table."""
    rows = enrich.with_status(
        readings.all_readings(spark, sf_dir).unionByName(
            readings.deliveries(spark, sf_dir).drop("arrival", "tick")
        )
    )
    return quality.check_raw(rows)


@query
def daily_checks(spark, sf_dir):
    return quality.check_daily(stage(_windows(spark, sf_dir).read(spark), "daily"))


@query
def window_lookup(spark, sf_dir):
    """Stored windows of just the keys the last tick touches."""
    rows = daily.assign_window(readings.deliveries(spark, sf_dir))
    last = readings.deliveries(spark, sf_dir).agg(F.max("tick")).scalar()
    return _windows(spark, sf_dir).lookup(spark, rows.where(F.col("tick") == last), daily.KEY).select("customer_id", "window_start", "event_count", "is_finalized")


@query
def latest_states(spark, sf_dir):
    """Latest cumulative state per window out of one row per window and tick."""
    rows = dedupe.keep_first_arrivals(readings.deliveries(spark, sf_dir))
    log = daily.fold(daily.assign_window(rows), (*daily.KEY, "tick"))
    return tables.latest(log, daily.KEY).select(
        "customer_id", "window_start", "tick", "event_count", "heart_rate_sum"
    )


# -- Metrics -------------------------------------------------------------------------------


@query
def latency_histogram(spark, sf_dir):
    """Cumulative histogram with the fixed bounds, per event type."""
    rows = readings.events(spark, sf_dir).withColumn("seconds", F.col("value") / 100)
    found = M.histogram(rows, F.col("seconds"), by=["event_type"])
    return found.select("event_type", F.when(
        F.col("le") == F.lit(M.INFINITY), F.lit("+Inf")).otherwise(
        F.format_number(F.col("le"), 3)).alias("le"), "count")


@query
def latency_quantiles(spark, sf_dir):
    """p50, p95 and p99 of the cumulative histogram, per event type."""
    rows = readings.events(spark, sf_dir).withColumn("seconds", F.col("value") / 100)
    buckets = M.histogram(rows, F.col("seconds"), by=["event_type"])
    return M.quantiles(buckets, (0.5, 0.95, 0.99), by=["event_type"], value="count")


@query
def partition_backlog(spark, sf_dir):
    """End offset less consumed position per partition; the position is the last valid message."""
    ends = M.end_offsets(readings.messages(spark, sf_dir))
    rows = readings.deliveries(spark, sf_dir)
    middle = rows.agg(F.call_function("div", F.max("seq"), F.lit(2))).scalar()
    positions = rows.where(F.col("seq") <= middle).groupBy(
        F.lit(readings.TOPIC).alias("topic"), F.col("src_partition").alias("partition")
    ).agg((F.max("seq") + 1).alias("position"))
    return M.backlog(ends, positions)


@query
def partition_load(spark, sf_dir):
    return M.load_share(readings.deliveries(spark, sf_dir))


def _samples(spark, sf_dir):
    return telemetry.metric_samples(spark, sf_dir)


def _staged_samples(spark, sf_dir):
    return stage(_samples(spark, sf_dir), "metric-samples", ["name"])


@query
def counter_rates(spark, sf_dir):
    """rate() of the processed counter per instance, at every step."""
    series = M.select_series(_samples(spark, sf_dir), telemetry.PROCESSED, ["instance"])
    return M.rate(series, ["instance"], LONG, telemetry.GRID).select(
        "instance", "eval_ts", "value"
    )


@query
def counter_increase(spark, sf_dir):
    """increase() of late events by outcome, not extrapolated."""
    labels = ["instance", "aggregated"]
    series = M.select_series(
        _samples(spark, sf_dir), telemetry.LATE, labels, {"job": telemetry.JOB})
    grown = M.increase(series, labels, LONG, telemetry.GRID, extrapolate=False)
    return M.across(grown, by=["aggregated"]).select("aggregated", "eval_ts", "value")


@query
def latency_p95(spark, sf_dir):
    """p95 over the rates of the latency buckets, at every step."""
    evaluated = telemetry.rates(_samples(spark, sf_dir), [telemetry.LATENCY_BUCKET], LONG)
    return telemetry.latency_quantile(evaluated, 0.95).select(
        "eval_ts", "value"
    )


@query
def gauge_summary(spark, sf_dir):
    """sum, max, min and count of a gauge over instances, at every step."""
    now = telemetry.gauges(_samples(spark, sf_dir), [telemetry.WATERMARK_LAG], LOOKBACK)
    return now.groupBy("eval_ts").agg(
        F.sum("value").alias("total"), F.max("value").alias("highest"),
        F.min("value").alias("lowest"), F.count("value").alias("instances"),
    )


@query
def absent_steps(spark, sf_dir):
    """Steps at which no instance reports being up."""
    samples = _samples(spark, sf_dir)
    up = telemetry.gauges(samples, [telemetry.UP], telemetry.SCRAPE_SECONDS)
    steps = M.spine(M.step_bounds(samples, telemetry.GRID), telemetry.GRID)
    return M.absent(steps, up).select("eval_ts", "value")


@query
def dead_letter_share(spark, sf_dir):
    """Share of dead-lettered messages at every step."""
    counters = [telemetry.DEAD_LETTERED, telemetry.PROCESSED]
    evaluated = telemetry.rates(_samples(spark, sf_dir), counters, LONG)
    return telemetry.dead_letter_share(evaluated).select("eval_ts", "value")


@query
def throughput_summary(spark, sf_dir):
    """The ten named values at the last scrape."""
    samples = _staged_samples(spark, sf_dir)
    at = M.step_bounds(samples, telemetry.GRID).select("hi").scalar()
    return telemetry.throughput_summary(
        samples, at, short=SHORT, long=LONG, lookback=LOOKBACK
    )


@query
def dashboard_feeds(spark, sf_dir):
    """Points, sum and peak of every legend of the nine dashboard panels."""
    feeds = telemetry.panels(
        _staged_samples(spark, sf_dir), short=SHORT, long=LONG, lookback=LOOKBACK
    )
    points = A.union_all([f.select("panel", "legend", "value") for f in feeds.values()])
    return points.groupBy("panel", "legend").agg(
        F.count("value").alias("points"),
        F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("peak"),
    )


# -- Alerts --------------------------------------------------------------------------------


def _alerts(spark, sf_dir, limits=LIMITS):
    found = telemetry.evaluate_rules(
        _staged_samples(spark, sf_dir), RULES, over=LONG, lookback=telemetry.SCRAPE_SECONDS,
        grid=telemetry.GRID, **limits,
    )
    return stage(found, "alerts")


@query
def alert_evaluations(spark, sf_dir):
    """Pending and firing steps per rule and instance."""
    return _alerts(spark, sf_dir).groupBy("alertname", "severity", "component", "instance").agg(
        F.count_if(F.col("state") == "pending").alias("pending"),
        F.count_if(F.col("state") == "firing").alias("firing"),
    )


@query
def default_limit_intervals(spark, sf_dir):
    """Active, fired and ended under the limits that the rules have by default."""
    return A.intervals(_alerts(spark, sf_dir, {}), telemetry.GRID)


@query
def alert_intervals(spark, sf_dir):
    """When every alert became active, fired and ended."""
    return A.intervals(_alerts(spark, sf_dir), telemetry.GRID)


@query
def stream_alert_intervals(spark, sf_dir):
    """The same intervals from a streaming query that evaluates the rules tick by tick."""
    topic = scratch_path(spark, "sample-topic")
    segments.publish(sample_message(_samples(spark, sf_dir)), topic, 1)
    rules = RuleStream(
        scratch_path(spark, "rules"), RULES, telemetry.GRID, LONG, telemetry.SCRAPE_SECONDS, limits=LIMITS)
    share = -(-segments.TopicLog(topic).ends().get(0, 1) // STREAM_TICKS)
    read = samples_of(segments.read_stream(spark, topic, "samples", share))
    running_query = rules.start(read, scratch_path(spark, "rules-checkpoint"), seconds=0).start()
    try:
        running_query.processAllAvailable()
    finally:
        running_query.stop()
    rules.flush(spark)
    return rules.intervals(spark)


@query
def rule_history(spark, sf_dir):
    """The notification history that the evaluated rules themselves lead to."""
    bounds = M.step_bounds(_samples(spark, sf_dir), telemetry.GRID)
    until = telemetry.GRID.time(F.lit(bounds.select("hi").scalar()))
    told = A.messages(A.intervals(_alerts(spark, sf_dir), telemetry.GRID), until)
    days = [[F.call_function("div", F.col("arrival"), F.lit(86_400_000_000 * n).cast("bigint"))]
            for n in (365, 1)]
    return incidents.notification_history(told, levels=days).select(
        "fingerprint", "episode_no", "alert_type", "severity", "status", "created_at", "resolved_at"
    )


@query
def rule_states(spark, sf_dir):
    """Inactive, pending or firing per rule, half way through the data."""
    bounds = M.step_bounds(_samples(spark, sf_dir), telemetry.GRID)
    at = bounds.select(F.call_function("div", F.col("lo") + F.col("hi"), F.lit(2))).scalar()
    return A.rule_states(spark, _alerts(spark, sf_dir), at, RULES)


@query
def uninhibited_alerts(spark, sf_dir):
    """Firing alerts left once a down consumer explains the rest."""
    return A.inhibit(A.firing(_alerts(spark, sf_dir))).select(
        "alertname", "component", "instance", telemetry.GRID.time(F.col("step")).alias("eval_ts")
    )


@query
def grouped_alerts(spark, sf_dir):
    """One row per alert name and component at every step."""
    groups = A.group(A.inhibit(A.firing(_alerts(spark, sf_dir))))
    return groups.select(
        "alertname", "component", "severity", "alerts",
        telemetry.GRID.time(F.col("oldest")).alias("oldest"),
        telemetry.GRID.time(F.col("step")).alias("eval_ts"),
    )


@query
def notification_schedule(spark, sf_dir):
    """Announcements per group: first, changed and repeated, routed by severity."""
    groups = A.group(A.inhibit(A.firing(_alerts(spark, sf_dir))))
    return A.schedule(groups, telemetry.GRID)


@query
def auto_resolved(spark, sf_dir):
    """Error updates per user as episodes that end after three quiet hours."""
    updates = readings.events(spark, sf_dir).where(F.col("event_type") == "error").select(
        F.col("user_id").alias("fingerprint"), F.col("ts").cast("timestamp").alias("ts")
    )
    return A.auto_resolve(updates, timeout=10_800)


@query
def parsed_alerts(spark, sf_dir):
    """Webhook bodies as typed alerts."""
    return alertlog.alert_log(spark, sf_dir).select(
        "arrival", F.col("position").cast("bigint").alias("position"), "fingerprint",
        "alert_type", "severity", "message", "source", "status", "created_at",
        F.size("labels").cast("bigint").alias("label_count"),
    )


def _alert_log(spark, sf_dir):
    # Parsed once and written: the transitions read it several times.
    return stage(alertlog.alert_log(spark, sf_dir), "alert-log")


@query
def notification_history(spark, sf_dir):
    """Episodes per fingerprint, opened by FIRING and closed by RESOLVED."""
    return _history(spark, sf_dir).drop("labels")


@query
def alert_transitions(spark, sf_dir):
    """What every received alert did: opened, closed or ignored."""
    return incidents.transitions(_alert_log(spark, sf_dir)).select(
        "arrival", F.col("position").cast("bigint").alias("position"), "fingerprint", "status",
        "transition", "episode_no",
    )


def _history(spark, sf_dir):
    return incidents.notification_history(_alert_log(spark, sf_dir))


@query
def recent_notifications(spark, sf_dir):
    return reports.recent_notifications(_history(spark, sf_dir))


@query
def notifications_since(spark, sf_dir):
    """Notifications of the ten days before the newest event."""
    newest = readings.events(spark, sf_dir).agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return reports.notifications_since(_history(spark, sf_dir), newest, days=10)


@query
def notifications_of_type(spark, sf_dir):
    """One alert type within ten days."""
    return reports.notifications_of_type(
        _history(spark, sf_dir), "DLQ_RATE_HIGH",
        F.timestamp_micros(F.lit(1704844800000000)), F.timestamp_micros(F.lit(1705708800000000)),
    ).select("fingerprint", "episode_no", "status", "created_at")


@query
def alert_counters(spark, sf_dir):
    return incidents.alert_counters(
        incidents.transitions(_alert_log(spark, sf_dir))
    )


@query
def notification_checks(spark, sf_dir):
    return quality.check_notifications(stage(_history(spark, sf_dir), "history"))


@query
def open_then_close(spark, sf_dir):
    """Notifications opened by the earlier half of the alerts, closed by the later half."""
    log = _alert_log(spark, sf_dir)
    middle = readings.events(spark, sf_dir).agg(
        F.call_function("div", F.max("event_id"), F.lit(2))
    ).scalar()
    earlier, later = log.where(F.col("arrival") <= middle), log.where(F.col("arrival") > middle)
    open_now = incidents.notification_history(earlier).where(F.col("status") == "FIRING")
    closed = incidents.close_open(later, open_now).select(
        "fingerprint", "status", "resolved_at"
    )
    opened = incidents.open_new(later, open_now).select(
        "fingerprint", F.lit("OPENED").alias("status"), F.col("received_at").alias("resolved_at")
    )
    return closed.unionByName(opened)
