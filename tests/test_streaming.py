"""Ticks against the closed form, replay, restart, compaction, alert ticks."""

from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import daily, dedupe, incidents
from tidemark.sources import topics
from tidemark.streaming.alertticks import AlertStream
from tidemark.streaming.native import native_daily, native_dedupe, with_native_watermark
from tidemark.streaming.progress import live_backlog
from tidemark.streaming.tables import IdTable
from tidemark.streaming.ticks import EventStream

START = dt.datetime(2026, 8, 1, tzinfo=dt.UTC)
DAY = 86_400

# (tick, customer, rate, seconds since START, id number); None id = broken message
SCRIPT = [
    (0, "a", 70, 3600, 0), (0, "b", 120, 4000, 1), (0, "a", 71, 3700, 2),
    (1, "a", 80, 2 * DAY, 3),            # closes day 0 of a and b
    (2, "a", 240, 5000, 4),              # too late for day 0
    (2, "c", 90, 6000, 5),               # opens an old window, closes it again
    (2, "a", 80, 2 * DAY, 3),            # redelivery
    (3, "c", 91, 6100, 6),               # refused: that window closed last tick
    (3, "a", 82, 2 * DAY + 50, 7), (3, "x", 10, 0, None),
]


def messages(spark):
    rows = []
    for offset, (tick, customer, rate, seconds, number) in enumerate(SCRIPT):
        body = {"customer_id": customer, "heart_rate": rate,
                "event_time": (START + dt.timedelta(seconds=seconds)).isoformat()}
        if number is not None:
            body["event_id"] = f"00000000-0000-4000-8000-{number:012d}"
        rows.append((tick, customer, json.dumps(body).encode(), "readings", 0, offset,
                     START + dt.timedelta(days=9, seconds=offset)))
    return spark.createDataFrame(
        rows, "tick bigint, key string, value binary, topic string, partition int, "
              "offset bigint, timestamp timestamp")


def run(spark, stream, ticks=range(4)):
    rows = messages(spark)
    for tick in ticks:
        stream.process(rows.where(F.col("tick") == tick).drop("tick"), tick)


COLUMNS = ["customer_id", "window_start", "event_count", "heart_rate_sum", "minimum_heart_rate",
           "maximum_heart_rate", "abnormal_count", "is_finalized"]


def state(spark, stream):
    return sorted(map(tuple, stream.daily(spark).select(COLUMNS).collect()))


def closed_form(spark):
    rows = messages(spark).where("offset < 9").select(
        F.col("offset").alias("arrival"), "tick",
        F.get_json_object(F.col("value").cast("string"), "$.event_id").alias("event_id"),
        F.col("key").alias("customer_id"),
        F.get_json_object(F.col("value").cast("string"), "$.heart_rate").cast("int").alias("heart_rate"),
        F.get_json_object(F.col("value").cast("string"), "$.event_time").cast("timestamp")
        .alias("event_time"))
    windows = daily.daily_by_event_time(dedupe.flag_first_arrivals(rows))
    return sorted(map(tuple, windows.select(COLUMNS).collect()))


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    stream = EventStream(str(tmp_path_factory.mktemp("stream")))
    run(spark, stream)
    return stream


def test_ticks_equal_closed_form(spark, finished):
    assert state(spark, finished) == closed_form(spark)


def test_stored_rows_and_flags(spark, finished):
    raw = {r["event_id"][-1]: r for r in finished.raw.read(spark).collect()}
    assert len(raw) == 8
    assert raw["4"]["is_late"] and raw["4"]["lateness_seconds"] == 2 * DAY - 300 - 5000
    assert not raw["3"]["is_late"] and raw["3"]["lateness_seconds"] is None
    letters = finished.dead_letters.read(spark).collect()
    assert [(r["source_offset"], r["dlq_key"]) for r in letters] == [(9, "x")]
    assert letters[0]["error_message"].startswith("event: 'event_id' is a required property")


def test_finalized_window_keeps_its_values(spark, finished):
    rows = [r for r in state(spark, finished) if r[0] == "a" and r[1].day == 1]
    assert rows[0][2:6] == (2, 141, 70, 71) and rows[0][-1]


def test_ledger_totals_and_samples(spark, finished):
    last = finished.ledger.read(spark).orderBy(F.desc("tick")).first()
    assert (last["processed"], last["duplicates"], last["dead_lettered"]) == (9, 1, 1)
    assert (last["late_aggregated"], last["late_finalized"], last["late_duplicate"]) == (1, 2, 0)
    assert last["windows_opened"] - last["windows_finalized"] == 1
    assert last["seconds_le_11"] == 10
    names = {r["name"]: r["value"] for r in
             finished.samples.read(spark).where("tick = 3 and labels['le'] is null").collect()}
    assert names["consumer_messages_processed_total"] == 9
    assert names["consumer_windows_open"] == 1


def everything(spark, stream):
    """Every row and column of every table."""
    tables = [stream.raw, stream.states, stream.dead_letters, stream.ledger, stream.samples]
    frames = [table.read(spark) for table in tables] + stream.ids.before(spark, 2**62)
    return [sorted(map(repr, frame.collect())) for frame in frames]


def test_replay_changes_nothing(spark, finished):
    before = everything(spark, finished)
    run(spark, finished, [2, 3])
    assert everything(spark, finished) == before


def test_changed_event_time_of_a_redelivery_counts_once(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    rows = messages(spark).where("offset = 0").drop("tick")
    later = rows.withColumn("value", F.encode(F.replace(
        F.decode("value", "utf-8"), F.lit("T01:00:00"), F.lit("T02:30:00")), "utf-8"))
    stream.process(rows, 0)
    stream.process(later, 1)
    assert stream.raw.read(spark).count() == 1
    assert [r[2] for r in state(spark, stream)] == [1]


def test_history_is_not_shuffled_beyond_the_broadcast_limit(spark, tmp_path):
    table = IdTable(str(tmp_path / "ids"), buckets=4)
    table.write(spark.range(4000).selectExpr("cast(id AS string) AS event_id"), 0)
    table.write(spark.range(4000, 8000).selectExpr("cast(id AS string) AS event_id"), 1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = spark.range(3000, 9000).selectExpr("cast(id AS string) AS event_id", "id AS arrival")
        found = dedupe.insert_if_absent(batch, lambda ids: table.found(ids, 2))
        lookup = table.found(batch, 2)
        plan = lookup._jdf.queryExecution().executedPlan().toString()
        assert lookup.count() == 5000 and found.where("is_new").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "tick" in line and "FileScan" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above, least = [], depth
    for line in reversed(lines[:scan]):  # the operators from the scan up to the root
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < least:
            above.append(line)
            least = indent
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above)


def test_ids_are_found_by_another_session_and_replays_replace_them(spark, tmp_path):
    table = IdTable(str(tmp_path / "ids"), buckets=2)
    for _ in range(2):
        table.write(spark.createDataFrame([("a",), ("b",)], "event_id string"), 0)
    spark.sql(f"DROP TABLE {table._table(spark, 0)}")  # the files stay: the table is external
    [ids] = table.before(spark, 1)
    assert sorted(r[0] for r in ids.collect()) == ["a", "b"]
    assert table.before(spark, 0)[0].count() == 0


def test_buckets_follow_the_history(spark, tmp_path):
    """Epochs of 2, 8 and 32 buckets; a look-up reads each as it lies, with as many tasks as buckets."""
    table = IdTable(str(tmp_path / "ids"), buckets=2, bucket_ids=100)
    assert [table.epoch(n) for n in (0, 199, 200, 999, 1000, 4199, 4200)] == [0, 0, 1, 1, 2, 2, 3]
    stored = 0
    for tick, size in enumerate((150, 100, 900, 500)):
        table.write(spark.range(stored, stored + size).selectExpr("cast(id AS string) AS event_id"), tick, stored)
        stored += size
    parts = table.before(spark, 4, stored)
    assert [p.count() for p in parts] == [250, 900, 500]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = spark.range(100, 2000).selectExpr("cast(id AS string) AS event_id", "id AS arrival")
        found = dedupe.insert_if_absent(batch, lambda ids: table.found(ids, 4, stored))
        assert found.where("is_new").agg(F.min("arrival"), F.count("*")).first() == (stored, 2000 - stored)
        plan = table.found(batch, 4, stored)._jdf.queryExecution().executedPlan().toString()
        assert [int(n) for n in re.findall(r"SelectedBucketsCount: \d+ out of (\d+)", plan)] == [2, 8, 32]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_stream_over_several_epochs_finds_its_redeliveries(spark, tmp_path):
    small = EventStream(str(tmp_path / "small"), id_buckets=1, bucket_ids=2)
    plain = EventStream(str(tmp_path / "plain"))
    for stream in (small, plain):
        run(spark, stream, [0, 1, 2, 3])
    columns = [c for c in plain.raw.read(spark).columns if c != "ingestion_time"]
    assert sorted(map(str, small.raw.read(spark).select(columns).collect())) == sorted(
        map(str, plain.raw.read(spark).select(columns).collect()))
    assert len(small.ids.before(spark, 9, 6)) > 1


def test_many_dates_keep_the_pruned_plan(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    run(spark, stream, [0, 1])
    days = spark.range(401).select(F.expr("timestamp'2020-01-01' + make_dt_interval(cast(id AS int))")
                                   .alias("window_start"))
    kept = stream._states_before(spark, 2, stream._relevant(days, int(START.timestamp() * 1e6)))
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()


def test_a_tick_reads_only_the_folders_since_the_last_base(spark, tmp_path):
    stream = EventStream(str(tmp_path / "often"), compact_every=2)
    plain = EventStream(str(tmp_path / "never"), compact_every=0)
    for each in (stream, plain):
        run(spark, each, [0, 1, 2, 3])
    drop = ["finalized_at"]
    assert sorted(map(str, stream.daily(spark).drop(*drop).collect())) == sorted(map(str, plain.daily(spark).drop(*drop).collect()))
    files = stream._states_before(spark, 4).inputFiles()
    assert files
    assert not any("daily_log/tick=0" in f or "daily_log/tick=1" in f or "daily_log/tick=2" in f for f in files)


def test_repeat_and_compaction(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    # The first attempt of tick 2 died before it was acknowledged; it runs again.
    run(spark, stream, [0, 1, 2, 2])
    before = state(spark, stream)
    stream.compact(spark, 1)
    assert state(spark, stream) == before
    run(spark, stream, [3])
    assert state(spark, stream) == closed_form(spark)


def test_file_stream_with_restart(spark, tmp_path):
    source, out = str(tmp_path / "topic"), str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")
    stream = EventStream(out)
    rows = messages(spark)

    def deliver_and_run(tick):
        topics.publish_files(rows.where(F.col("tick") == tick).drop("tick").coalesce(1), source)
        query = stream.start(topics.read_topic_files_stream(spark, source, 1), checkpoint,
                             seconds=None).start()
        query.awaitTermination()

    for tick in range(4):  # each run resumes from the checkpoint of the one before
        deliver_and_run(tick)
    assert state(spark, stream) == closed_form(spark)


def test_empty_ticks_are_harmless(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    rows = messages(spark)
    empty = rows.where("offset < 0").drop("tick")
    stream.process(empty, 0)
    stream.process(rows.where(F.col("tick") == 0).drop("tick"), 1)
    stream.process(empty, 2)
    ledger = [r["processed"] for r in stream.ledger.read(spark).orderBy("tick").collect()]
    assert ledger == [0, 3, 3] and len(state(spark, stream)) == 2


def bodies(spark, script):
    rows = [(i, START + dt.timedelta(minutes=i), json.dumps({"alerts": [
        {"status": s, "fingerprint": f, "labels": {"alertname": "KafkaLagHigh"},
         "startsAt": (START + dt.timedelta(minutes=i)).isoformat()}]}))
        for i, (f, s) in enumerate(script)]
    return spark.createDataFrame(rows, "arrival bigint, received_at timestamp, body string")


def test_alert_ticks_equal_batch_history(spark, tmp_path):
    script = [("f", "firing"), ("g", "resolved"), ("f", "firing"), ("f", "resolved"),
              ("f", "firing"), ("g", "firing"), ("f", "firing"), ("g", "resolved"),
              ("f", "resolved"), ("f", "resolved"), ("f", "firing"), ("h", "firing")]
    rows = bodies(spark, script)
    want = incidents.notification_history(incidents.parse_alerts(rows))
    for size in (3, 12):
        stream = AlertStream(str(tmp_path / str(size)))
        for tick in range(0, len(script) // size):
            part = rows.where((F.col("arrival") >= tick * size) & (F.col("arrival") < (tick + 1) * size))
            stream.process(part, tick)
            if tick == 1:
                stream.process(part, tick)
        columns = [c for c in want.columns if c != "labels"]
        got = stream.notifications(spark).select(columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(columns).collect()))
        counted = stream.counts.read(spark).agg(
            F.sum("persisted"), F.sum("duplicates_ignored")).first()
        assert tuple(counted) == (8, 4)


def test_native_variant_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.createDataFrame(
        [("a", "c", 70, START), ("a", "c", 70, START), ("b", "c", 150, START + dt.timedelta(days=9))],
        "event_id string, customer_id string, heart_rate int, event_time timestamp")
    rows.coalesce(1).write.parquet(source)
    stream = native_daily(native_dedupe(with_native_watermark(
        spark.readStream.schema(rows.schema).parquet(source))))
    query = (stream.writeStream.outputMode("append").format("memory").queryName("native_daily")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    closed = spark.table("native_daily").collect()
    assert [(r["customer_id"], r["event_count"]) for r in closed] == [("c", 1)]


def test_live_backlog_reads_progress(spark):
    progress = {"sources": [{"endOffset": json.dumps({"t": {"0": 5, "1": 9}}),
                             "latestOffset": {"t": {"0": 7, "1": 9}}}]}
    got = {r["partition"]: r["lag"] for r in live_backlog(spark, progress).collect()}
    assert got == {0: 2, 1: 0}
