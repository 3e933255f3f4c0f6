"""The partitioned topic: offsets, units, bounded ticks, restarts and lag."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources import segments
from tidemark.streaming.progress import live_backlog
from tidemark.streaming.ticks import EventStream

KEYS = 20


def rows(spark, first, last):
    number = F.col("id")
    return spark.range(first, last).select(
        F.concat(F.lit("k"), (number % KEYS).cast("string")).alias("key"),
        number.cast("string").cast("binary").alias("value"), F.timestamp_seconds("id").alias("timestamp"),
    )


def read(spark, path):
    return segments.read_batch(spark, path, "t").withColumn("number", F.col("value").cast("string").cast("long"))


def drain(spark, path, checkpoint, limit, handle):
    query = segments.read_stream(spark, path, "t", limit).writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint).start()
    query.processAllAvailable()
    progress = json.loads(query.lastProgress.json)
    query.stop()
    return progress


def test_offsets_have_no_gap_and_keys_keep_their_partition_and_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    segments.publish(rows(spark, 0, 700), path)
    segments.publish(rows(spark, 700, 1000), f"file://{path}")
    found = read(spark, path).collect()
    assert sorted(r.number for r in found) == list(range(1000))
    for partition in range(3):
        held = sorted((r for r in found if r.partition == partition), key=lambda r: r.offset)
        assert [r.offset for r in held] == list(range(len(held)))
        assert [r.number for r in held] == sorted(r.number for r in held)
    assert len({(r.key, r.partition) for r in found}) == KEYS
    assert {r.topic for r in found} == {"t"}


def test_a_busy_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "topic")
    one = rows(spark, 0, 4000).withColumn("partition", F.lit(0))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments.publish(one, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(segments.TopicLog(path).commit(0)["segments"]) > 1
    found = [r.number for r in read(spark, path).orderBy("offset").collect()]
    assert found == list(range(4000))


def test_a_batch_published_again_is_not_appended_again(spark, tmp_path):
    path = str(tmp_path / "topic")
    for _ in range(2):
        segments.publish(rows(spark, 0, 50), path, writer="w", batch="7")
    segments.publish(rows(spark, 50, 60), path, writer="w", batch="8")
    assert sorted(r.number for r in read(spark, path).collect()) == list(range(60))


def test_an_aborted_batch_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "topic")
    segments.publish(rows(spark, 0, 30), path)
    broken = rows(spark, 30, 60).withColumn(
        "value", F.when(F.col("key") == "k3", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("value")))
    with pytest.raises(PySparkException):
        segments.publish(broken, path)
    assert read(spark, path).count() == 30
    segments.publish(rows(spark, 30, 40), path)
    assert sorted(r.number for r in read(spark, path).collect()) == list(range(40))


def test_ticks_are_bounded_and_go_on_after_a_restart(spark, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    ticks = []

    def handle(batch, number):
        ticks.append((number, [(r.partition, r.offset) for r in batch.collect()]))

    segments.publish(rows(spark, 0, 300).withColumn("partition", (F.col("timestamp").cast("long") % 3).cast("int")), path)
    drain(spark, path, checkpoint, 90, handle)
    segments.publish(rows(spark, 300, 450).withColumn("partition", F.lit(1)), path)
    progress = drain(spark, path, checkpoint, 90, handle)
    assert [n for n, _ in ticks] == list(range(len(ticks)))
    assert all(len(found) <= 90 for _, found in ticks)
    seen = [place for _, found in ticks for place in found]
    assert len(seen) == len(set(seen)) == 450
    assert progress["sources"][0]["endOffset"] == {"t": {"0": 100, "1": 250, "2": 100}}


def test_progress_and_the_log_give_the_lag(spark, tmp_path):
    path, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    segments.publish(rows(spark, 0, 100).withColumn("partition", F.lit(0)), path)
    progress = drain(spark, path, checkpoint, None, lambda batch, n: batch.count())
    segments.publish(rows(spark, 0, 7).withColumn("partition", F.lit(0)), path)
    lag = live_backlog(spark, progress, segments.ends(spark, path, "t")).collect()
    assert [(r.topic, r.partition, r.lag) for r in lag] == [("t", 0, 7)]


def test_a_large_range_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "topic")
    segments.publish(rows(spark, 0, 1000), path)
    found = segments.register(spark).read.format(segments.FORMAT).options(path=path, topic="t", rowsPerTask=100).load()
    assert found.rdd.getNumPartitions() >= 10
    assert found.select("partition", "offset").distinct().count() == 1000


def test_commits_are_found_without_reading_all(tmp_path):
    log = segments.TopicLog(str(tmp_path))
    for number in range(41):
        log.append([(0, number % 3, 10, f"data/{number}")], "w", number)
    fresh = segments.TopicLog(str(tmp_path))
    assert fresh.last() == 40
    assert fresh.ends() == {0: 140, 1: 140, 2: 130}
    assert [(s.partition, s.base) for s in fresh.segments({0: 135, 1: 140, 2: 120}, {0: 140, 1: 140, 2: 125})] == [(2, 120), (0, 130)]
    assert fresh.segments({0: 140}, {0: 140}) == []
    assert len([f for f in os.listdir(tmp_path / "commits") if f.startswith(".")]) == 0


def test_publishing_a_stream_once(spark, tmp_path):
    """A tick that fails after its commit is published once only."""
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "topic"), str(tmp_path / "cp")
    rows(spark, 0, 40).write.parquet(source)
    stream = spark.readStream.schema("key string, value binary, timestamp timestamp").parquet(source)
    for _ in range(2):
        segments.publish_stream(stream, path, checkpoint).trigger(availableNow=True).start().awaitTermination()
        rows(spark, 40, 55).write.mode("append").parquet(source)
    assert read(spark, path).where("number < 40").count() == 40


def event(number, **changes):
    body = {"event_id": f"00000000-0000-4000-8000-{number:012d}", "customer_id": "customer-001", "heart_rate": 75,
            "event_time": f"2026-08-30T10:00:{number:02d}+00:00", **changes}
    return json.dumps({k: v for k, v in body.items() if v is not None})


@pytest.fixture
def path_of(spark, tmp_path):
    """Runs message texts, in order, through topic and stream, so many a tick; gives the stream."""

    def run(texts, per_tick=2):
        topic = str(tmp_path / "topic")
        messages = spark.createDataFrame(
            [("customer-001", t.encode(), i, 0) for i, t in enumerate(texts)], "key string, value binary, at long, partition int"
        ).withColumn("timestamp", F.timestamp_seconds("at")).drop("at")
        segments.publish(messages, topic)
        stream = EventStream(str(tmp_path / "tables"))
        query = stream.start(segments.read_stream(spark, topic, "t", per_tick), str(tmp_path / "cp"), seconds=0).start()
        query.processAllAvailable()
        query.stop()
        return stream

    return run


def test_broken_messages_take_no_part_and_valid_ones_follow(spark, path_of):
    texts = [event(1), event(2, heart_rate=5), "not json", event(3, customer_id=None), event(4, heart_rate=180)]
    stream = path_of(texts)
    assert sorted(r.event_id[-1] for r in stream.raw.read(spark).collect()) == ["1", "4"]
    letters = sorted((r.source_offset, r.error_type, r.dlq_key) for r in stream.dead_letters.read(spark).collect())
    assert letters == [(1, "VALIDATION_ERROR", "customer-001"), (2, "DECODE_ERROR", "unknown"), (3, "VALIDATION_ERROR", "unknown")]
    assert [(r.event_count, r.abnormal_count) for r in stream.daily(spark).collect()] == [(2, 1)]


def test_redeliveries_across_ticks_count_once(spark, path_of):
    texts = [event(n, heart_rate=70 + n) for n in range(1, 6)]
    stream = path_of([*texts, texts[0], texts[3]], per_tick=3)
    assert stream.raw.read(spark).count() == 5
    assert [(r.event_count, r.heart_rate_sum) for r in stream.daily(spark).collect()] == [(5, 365)]


def test_a_reader_holds_a_part_of_a_row_group(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "topic")
    segments.publish(rows(spark, 0, 1000), path, 1)
    monkeypatch.setattr(segments, "ROW_GROUP", 64)
    [task] = segments._ranges(segments.TopicLog(path), {0: 130}, {0: 777}, 10_000)
    batches = list(segments._read(path, "t", task))
    assert max(b.num_rows for b in batches) <= 64
    assert [n for b in batches for n in b.column("offset").to_pylist()] == list(range(130, 777))
    assert [int(v) for b in batches for v in b.column("value").to_pylist()] == list(range(130, 777))
    assert {t for b in batches for t in b.column("topic").to_pylist()} == {"t"}


def test_a_tick_of_a_busy_partition_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "topic")
    segments.publish(rows(spark, 0, 200_000), path, 1)
    assert read(spark, path).rdd.getNumPartitions() >= 4
