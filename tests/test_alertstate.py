"""Notifications kept by keyed state: the lifecycle, restarts, timers, and hot fingerprints."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incidents
from tidemark.sources import segments
from tidemark.streaming.alertstate import AlertEpisodes, fold

START = dt.datetime(2026, 8, 31, 14, 0, tzinfo=dt.UTC)
BODY = "arrival bigint, received_at timestamp, body string"


def bodies(spark, script, first=0):
    """(fingerprint, status, minute) as webhook bodies, in order."""
    rows = [(first + i, START + dt.timedelta(minutes=minute), json.dumps({"alerts": [
        {"status": status, "fingerprint": name, "labels": {"alertname": "ConsumerDown", "severity": "CRITICAL"},
         "startsAt": (START + dt.timedelta(minutes=minute)).isoformat()}]}))
        for i, (name, status, minute) in enumerate(script)]
    return spark.createDataFrame(rows, BODY)


@pytest.fixture
def played(spark, tmp_path):
    """Plays scripts one after another, each in a query of its own; gives (status, minutes) by episode."""

    def play(*scripts, timeout=None, per_tick=None, partitions=1):
        stream = AlertEpisodes(str(tmp_path / "out"), timeout, partitions)
        arrived, seen = 0, []
        for script in scripts:
            bodies(spark, script, arrived).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            arrived += len(script)
            arriving = spark.readStream.schema(BODY).parquet(str(tmp_path / "in"))
            stream.publish(arriving, str(tmp_path / "publish")).trigger(availableNow=True).start().awaitTermination()
            query = stream.start(spark, str(tmp_path / "state"), max_per_tick=per_tick, seconds=0)
            query.processAllAvailable()
            query.stop()
            minute = lambda t: None if t is None else int((t.replace(tzinfo=dt.UTC) - START).total_seconds() // 60)
            rows = stream.notifications(spark).withColumn("resolved_at", F.col("resolved_at").cast("timestamp_ntz")).withColumn(
                "created_at", F.col("created_at").cast("timestamp_ntz")).collect()
            seen.append(sorted(
                (r.fingerprint, r.episode_no, r.status, minute(r.created_at), minute(r.resolved_at)) for r in rows))
        return seen

    return play


LIFE = [("f", "firing", 0), ("g", "resolved", 1), ("f", "firing", 2), ("f", "resolved", 3), ("f", "firing", 4),
        ("g", "firing", 5), ("f", "firing", 6), ("g", "resolved", 7), ("f", "resolved", 8), ("f", "resolved", 9),
        ("f", "firing", 10), ("h", "firing", 11)]
HISTORY = [("f", 1, "RESOLVED", 0, 3), ("f", 2, "RESOLVED", 4, 8), ("f", 3, "FIRING", 10, None),
           ("g", 1, "RESOLVED", 5, 7), ("h", 1, "FIRING", 11, None)]


def test_life_of_notifications(played):
    assert played(LIFE, per_tick=3) == [HISTORY]


def test_state_survives_restarts(played):
    """Three queries after each other from one checkpoint."""
    assert played(LIFE[:2], LIFE[2:7], LIFE[7:])[-1] == HISTORY


def test_equals_the_batch_history(spark, played):
    want = incidents.notification_history(incidents.parse_alerts(bodies(spark, LIFE))).collect()
    assert sorted((r.fingerprint, r.episode_no, r.status) for r in want) == [x[:3] for x in HISTORY]


def test_a_timer_closes_an_alert_that_stays_silent(played):
    """No message about f comes again: only its timer can close it."""
    first = [("f", "firing", 0), ("f", "firing", 1)]
    seen = played(first, [("g", "firing", 2)], [("g", "firing", 30)], timeout=120)
    assert seen[0] == [("f", 1, "FIRING", 0, None)]
    assert seen[-1] == [("f", 1, "RESOLVED", 0, 3), ("g", 1, "RESOLVED", 2, 4), ("g", 2, "FIRING", 30, None)]


def test_a_late_message_finds_the_alert_already_over(played):
    script = [("f", "firing", 0), ("f", "resolved", 9), ("f", "firing", 10), ("f", "firing", 11), ("f", "firing", 20)]
    assert played(script, timeout=120) == [[
        ("f", 1, "RESOLVED", 0, 2), ("f", 2, "RESOLVED", 10, 13), ("f", 3, "FIRING", 20, None)]]


def test_a_slower_partition_takes_a_timer_back(spark, tmp_path):
    """The timer fires by the other partition's time; the repeat that was in time comes a tick later."""
    stream = AlertEpisodes(str(tmp_path / "out"), 120, 2)
    alerts = incidents.parse_alerts(bodies(spark, [("f", "firing", 0), ("f", "firing", 1), ("g", "firing", 60)]))
    value = F.to_json(F.struct(
        "arrival", "position", F.unix_micros("received_at").alias("received_at"), "fingerprint", "alert_type", "severity",
        "message", "source", "status", F.unix_micros("created_at").alias("created_at"), "labels"))
    keyed = alerts.select(F.col("fingerprint").alias("key"), value.cast("binary").alias("value"),
                          F.col("received_at").alias("timestamp"),
                          F.when(F.col("fingerprint") == "f", 0).otherwise(1).alias("partition"))
    segments.publish(keyed, stream.topic, 2)
    query = stream.start(spark, str(tmp_path / "state"), max_per_tick=2, seconds=0)
    query.processAllAvailable()
    query.stop()
    log = stream.log.read(spark)
    assert log.groupBy("fingerprint", "episode_no", "tick").count().where("count > 1").count() == 0
    assert stream.notifications(spark).count() == 2
    final = {r.fingerprint: (r.episode_no, r.status, r.resolved_at) for r in stream.notifications(spark).collect()}
    assert final["f"][:2] == (1, "RESOLVED")
    ends = stream.notifications(spark).where("fingerprint = 'f'").select(F.unix_micros("resolved_at").alias("t")).first().t
    assert ends == int((START + dt.timedelta(minutes=3)).timestamp() * 1e6)


def test_an_alert_whose_time_is_over_when_it_comes_has_one_row(spark, played):
    """One partition is far ahead in time: what the other still brings opens and runs out in one tick."""
    script = [("f", "firing", 0), *[(f"g{i}", "firing", 100 + i) for i in range(6)], ("f", "firing", 1), ("f", "firing", 90)]
    [seen] = played(script, timeout=120, per_tick=2, partitions=2)
    assert len(seen) == len({x[:2] for x in seen})
    assert [x for x in seen if x[0] == "f"][0] == ("f", 1, "RESOLVED", 0, 3)


@pytest.mark.parametrize("timeout", [None, 120_000_000])
def test_a_hot_fingerprint_is_folded_before_it_meets_the_state(spark, timeout):
    """100,000 repeats reach the state as a few rows a task."""
    rows = spark.range(0, 100_000, numPartitions=4).select(
        F.lit("hot").alias("fingerprint"), *[F.lit("x").alias(n) for n in ("alert_type", "severity", "message", "source")],
        F.when(F.col("id") == 50_010, "RESOLVED").otherwise("FIRING").alias("status"), F.lit(0).cast("long").alias("created_at"),
        F.col("id").alias("offset"), (F.col("id") * 1_000_000).alias("received_at"),
        F.create_map(F.lit("a"), F.lit("b")).alias("labels"))
    from tidemark.streaming.alertstate import _FOLDED

    folded = rows.mapInArrow(fold(timeout), _FOLDED).orderBy("offset").collect()
    assert sum(r.alerts for r in folded) == 100_000
    assert len(folded) < 30
    assert [r.offset for r in folded if r.status == "RESOLVED"] == [50_010]


def test_a_body_is_parsed_once_before_it_is_published(spark, tmp_path):
    """Publishing samples its rows, and writes them; neither parses them again."""
    bodies(spark, LIFE).write.parquet(f"{tmp_path}/bodies")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(body):
        calls.add(1)
        return body

    arriving = spark.readStream.schema(bodies(spark, LIFE).schema).parquet(f"{tmp_path}/bodies")
    arriving = arriving.withColumn("body", seen.asNondeterministic()("body"))
    stream = AlertEpisodes(f"{tmp_path}/alerts")
    stream.publish(arriving, f"{tmp_path}/in").trigger(availableNow=True).start().awaitTermination()
    assert calls.value == bodies(spark, LIFE).count()
