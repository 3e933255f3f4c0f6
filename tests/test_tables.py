"""Sources, sinks, quality checks, reports and scalars."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import clamp_min, round_half_up
from tidemark.operators import enrich, quality
from tidemark.plans import reports
from tidemark.session import shared_dir, stage
from tidemark.sources import tables, topics


def test_broker_options():
    source = topics.source_options("b:9092", "readings", max_per_tick=1000)
    assert source["startingOffsets"] == "earliest" and source["maxOffsetsPerTrigger"] == "1000"
    sink = topics.sink_options("b:9092", "readings", compression="zstd")
    assert sink["kafka.acks"] == "all" and sink["kafka.compression.type"] == "zstd"


def test_json_lines_skip_blanks(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a":1}\n\n   \n{"a":2}\n')
    assert topics.read_json_lines(spark, str(tmp_path)).count() == 2
    stream = topics.read_json_lines_stream(spark, str(tmp_path))
    query = stream.writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("lines").count() == 2


def test_messages_are_compact_and_keyed(spark):
    rows = spark.createDataFrame([("e", "customer-é", 75)],
                                 "event_id string, customer_id string, heart_rate int")
    row = topics.to_messages(rows).first()
    assert row["key"] == "customer-é"
    assert row["value"] == '{"event_id":"e","customer_id":"customer-é","heart_rate":75}'


def test_added_columns_get_defaults(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a",)], "event_id string").write.parquet(path)
    spark.createDataFrame([("b", True)], "event_id string, is_late boolean").write.mode(
        "append").parquet(path)
    got = tables.read_evolved(spark, path, {"is_late": F.lit(False), "note": F.lit("none")})
    assert {(r["event_id"], r["is_late"], r["note"]) for r in got.collect()} == {
        ("a", False, "none"), ("b", True, "none")}


def test_latest_and_lookup(spark):
    log = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 1, 5)],
                                "k string, tick bigint, v int")
    newest = tables.latest(log, ["k"])
    assert {(r["k"], r["v"]) for r in newest.collect()} == {("a", 30), ("b", 5)}
    keys = spark.createDataFrame([("b",), ("b",)], "k string")
    assert tables.lookup(newest, keys, ["k"]).count() == 1


def test_dated_folders_prune(spark, tmp_path):
    path = str(tmp_path / "raw")
    days = [dt.datetime(2026, 8, d, 12) for d in (1, 2, 3)]
    tables.write_by_date(spark.createDataFrame([(d,) for d in days], "event_time timestamp"), path)
    plan = tables.read_table(spark, path).where("event_date = date'2026-08-02'")
    assert plan.count() == 1
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_stage_uses_the_shared_folder(spark):
    df = stage(spark.range(10).toDF("n"), "numbers")
    assert df.count() == 10 and all(f.startswith("file:") for f in df.inputFiles())
    assert shared_dir(spark) in df.inputFiles()[0]


RAW = "event_id string, customer_id string, heart_rate int, event_time timestamp, status string"


def test_raw_checks(spark):
    when = dt.datetime(2026, 8, 1)
    rows = [("1", "a", 75, when, "NORMAL"), ("1", "a", 500, when, "ODD"), ("2", None, 20, when, None)]
    got = {r["rule"]: r["violations"] for r in quality.check_raw(spark.createDataFrame(rows, RAW)).collect()}
    assert got["heart_rate_range"] == 1 and got["status_values"] == 1
    assert got["event_id_unique"] == 1 and got["customer_id_not_null"] == 1
    assert got["status_not_null"] == 1 and got["event_time_not_null"] == 0


def test_one_open_notification_per_fingerprint(spark):
    when = dt.datetime(2026, 8, 1)
    rows = [("f", "T", "m", "INFO", "FIRING", when, None), ("f", "T", "m", "INFO", "FIRING", when, None),
            ("f", "T", "m", "INFO", "RESOLVED", when, None), ("g", "T", "m", "BAD", "FIRING", when, when)]
    df = spark.createDataFrame(
        rows, "fingerprint string, alert_type string, message string, severity string, "
              "status string, created_at timestamp, resolved_at timestamp")
    got = {r["rule"]: r["violations"] for r in quality.check_notifications(df).collect()}
    assert got["one_open_per_fingerprint"] == 1
    assert got["resolved_has_time"] == 2 and got["severity_values"] == 1


def test_reconcile_shows_one_sided_windows_only_when_full(spark):
    day = dt.datetime(2026, 8, 1)
    daily = spark.createDataFrame(
        [("a", day, False, 2), ("b", day, False, 1), ("c", day, True, 1)],
        "customer_id string, window_start timestamp, is_finalized boolean, event_count bigint")
    raw = spark.createDataFrame(
        [("a", day), ("a", day), ("c", day), ("c", day), ("d", day)],
        "customer_id string, event_time timestamp")
    inner = {r["customer_id"]: r["reconciles"] for r in quality.reconcile(daily, raw).collect()}
    assert inner == {"a": True}
    full = {r["customer_id"]: r["reconciles"] for r in
            quality.reconcile(daily, raw, how="full", open_windows_only=False).collect()}
    assert full == {"a": True, "b": False, "c": False, "d": False}


def test_rounding_and_clamp(spark):
    row = spark.createDataFrame([(2.25, 2.35, -2.25, 0.0)], "a double, b double, c double, z double")
    got = row.select(round_half_up(F.col("a"), 1), round_half_up(F.col("b"), 1),
                     round_half_up(F.col("c"), 1), clamp_min(F.col("z"), 0.001)).first()
    assert [str(got[0]), str(got[1]), str(got[2])] == ["2.3", "2.4", "-2.3"] and got[3] == 0.001


def test_stamp_fills_only_what_is_missing(spark):
    rows = spark.createDataFrame([("a", None), ("b", "ABNORMAL")], "event_id string, status string")
    got = {r["event_id"]: r for r in enrich.stamp(rows, F.lit(dt.datetime(2026, 8, 1))).collect()}
    assert got["a"]["status"] == "NORMAL" and got["b"]["status"] == "ABNORMAL"
    assert got["a"]["is_late"] is False and got["a"]["ingestion_time"].day == 1


def test_retention_and_recent_notifications(spark):
    as_of = dt.datetime(2026, 8, 31)
    rows = [("f", i, "T", "INFO", "FIRING", as_of - dt.timedelta(days=i), None) for i in (0, 29, 30, 40)]
    df = spark.createDataFrame(
        rows, "fingerprint string, episode_no bigint, alert_type string, severity string, "
              "status string, created_at timestamp, resolved_at timestamp")
    assert reports.notifications_since(df, F.lit(as_of)).count() == 2
    assert [r["episode_no"] for r in reports.recent_notifications(df, 2).collect()] == [0, 29]
    assert enrich.within_retention(df, 30, F.lit(as_of), "created_at").count() == 3


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Context:
        master = "yarn"

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        shared_dir(Session())
