"""A stream whose input stops is seen to stand still."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from test_streaming import DAY, START, run
from tidemark.plans.telemetry import evaluate_rules
from tidemark.streaming import liveness
from tidemark.streaming.ticks import EventStream

NEWEST = START + dt.timedelta(seconds=2 * DAY)


def test_watermark_stuck_fires_when_input_stops(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    run(spark, stream, [0, 1])
    for minute in range(0, 31, 2):
        liveness.beat(spark, stream, NEWEST + dt.timedelta(minutes=minute))
    beats = liveness.pulses(stream).read(spark).drop("tick")
    found = evaluate_rules(beats, over=300, lookback=300)
    rows = found.where("alertname = 'WatermarkStuck'").collect()
    assert rows and any(r["state"] == "firing" for r in rows)
    assert not found.where("alertname = 'ConsumerDown'").collect()


def test_beats_before_any_tick_and_partition_lag(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    progress = {"sources": [{"endOffset": json.dumps({"t": {"0": 5, "1": 9}}),
                             "latestOffset": {"t": {"0": 7, "1": 9}}}]}
    for _ in range(2):  # the same moment again
        liveness.beat(spark, stream, START, progress)
    got = {(r["name"], r["labels"].get("partition")): r["value"]
           for r in liveness.samples(spark, stream).collect()}
    assert got == {("up", None): 1.0, ("consumer_partition_lag", "0"): 2.0,
                   ("consumer_partition_lag", "1"): 0.0}
    assert liveness.samples(spark, stream).where(F.col("ts") != F.lit(START)).count() == 0


def test_a_forced_flush_changes_nothing_but_the_totals(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    stream.flush(spark)  # nothing ran yet
    run(spark, stream, [0, 1])
    before = sorted(map(str, stream.daily(spark).collect()))
    stream.flush(spark)
    stream.flush(spark)
    assert sorted(map(str, stream.daily(spark).collect())) == before
    ledger = stream.ledger.read(spark).orderBy("tick").collect()
    assert [r.tick for r in ledger] == [0, 1, 2, 3]
    assert ledger[-1].processed == ledger[1].processed


def test_beats_of_whole_days_become_one_folder_a_day(spark, tmp_path):
    stream = EventStream(str(tmp_path))
    run(spark, stream, [0])
    for hours in (0, 6, 23, 25, 30, 49):
        liveness.beat(spark, stream, START.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(hours=hours))
    before = sorted(map(str, liveness.samples(spark, stream).collect()))
    for _ in range(2):  # safe to repeat
        liveness.compact_beats(spark, stream, START.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(hours=50))
    assert liveness.beaten(stream).read(spark).select("tick").distinct().count() == 2
    assert sorted(map(str, liveness.samples(spark, stream).collect())) == before
