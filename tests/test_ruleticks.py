"""Rules evaluated tick by tick give what one evaluation over all samples gives."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import alerts as A
from tidemark.operators import metrics as M
from tidemark.plans import telemetry as P
from tidemark.streaming.ruleticks import RuleStream, sample_message, samples_of

START = dt.datetime(2026, 8, 31, tzinfo=dt.UTC)
GRID = M.Grid(step=15)
LIMITS = {"lag_limit": 10_000, "latency_limit": 0.5, "share_limit": 0.05, "watermark_limit": 900}


def scrape(second, instance, rng):
    """The samples of one scrape: conditions come and go, counters restart."""
    labels = {"job": P.JOB, "instance": instance}
    ts = START + dt.timedelta(seconds=second)
    phase = second // 200
    counter = float(second % 700 * (1 + int(instance[-1])))
    return [
        (ts, P.UP, labels, float(phase % 3 != 1)), (ts, P.SINK_UP, labels, float(rng.random() > 0.3)),
        (ts, P.PARTITION_LAG, {**labels, "partition": instance[-1]}, 20_000.0 if phase % 2 else 10.0),
        (ts, P.WATERMARK_LAG, labels, 300.0 + second % 1100), (ts, P.PROCESSED, labels, counter * 10),
        (ts, P.DEAD_LETTERED, labels, counter * (1 if phase % 2 else 0.1)),
        *[(ts, P.LATENCY_BUCKET, {**labels, "le": le}, counter * part)
          for le, part in (("0.25", 0.5), ("0.5", 0.8 if phase % 2 else 0.99), ("1.0", 1.0), ("+Inf", 1.0))],
    ]


@pytest.fixture(scope="module")
def samples(spark):
    """Half an hour of scrapes by two instances, with an outage longer than any range."""
    rng = random.Random(3)
    rows = [row for second in range(0, 1800, 15) if not 700 <= second < 1150
            for instance in ("i-0", "i-1") for row in scrape(second, instance, rng)]
    return rows, spark.createDataFrame(rows, schemas.METRIC_SAMPLE)


def key(rows):
    return sorted(tuple(str(v) for v in r) for r in rows.collect())


@pytest.mark.parametrize("cuts", [[900], [110, 111, 705, 1149], list(range(95, 1800, 95))])
def test_equals_one_evaluation_however_it_is_cut(spark, tmp_path, samples, cuts):
    rows, every = samples
    want = A.intervals(P.evaluate_rules(every, over=300, lookback=300, grid=GRID, **LIMITS), GRID)
    stream = RuleStream(str(tmp_path), A.RULES, GRID, limits=LIMITS)
    edges = [-1, *cuts, 10_000]
    for tick, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        part = [r for r in rows if low < (r[0] - START).total_seconds() <= high]
        batch = spark.createDataFrame(part, schemas.METRIC_SAMPLE)
        stream.process(batch, tick)
        if tick == 1:
            stream.process(batch, tick)
        # What is kept for the next tick is bounded by the range, not by the history.
        series = len({(n, str(sorted(labels.items()))) for _, n, labels, _ in rows})
        assert stream.tail.only(spark, tick).count() <= series * (300 // 15 + 2)
        if len(cuts) > 10 and tick == 6:
            break
    if len(cuts) <= 10:
        stream.flush(spark)
        assert key(stream.intervals(spark)) == key(want)
    else:
        # In the midst of the stream: runs that are over by now are known, with the same times.
        until = max(r[0] for r in rows if (r[0] - START).total_seconds() <= edges[7]) - dt.timedelta(seconds=15)
        ended = key(want.where(F.col("ended_at") < F.lit(until)))
        assert ended
        assert set(ended) <= set(key(stream.intervals(spark)))


def test_a_hold_time_spans_ticks(spark, tmp_path):
    """Lag stays high for 330 s, a tick every 60 s: it fires 300 s after it began."""
    stream = RuleStream(str(tmp_path), A.RULES, GRID)
    labels = {"job": P.JOB, "instance": "i", "partition": "0"}
    for tick in range(6):
        rows = [(START + dt.timedelta(seconds=60 * tick + s), P.PARTITION_LAG, labels, 50_000.0) for s in (0, 15, 30, 45)]
        rows += [(ts, P.UP, labels, 1.0) for ts, *_ in rows]
        stream.process(spark.createDataFrame(rows, schemas.METRIC_SAMPLE), tick)
    found = stream.intervals(spark).where("alertname = 'KafkaLagHigh'").select(
        F.col("fired_at").cast("long") - F.col("active_at").cast("long")).collect()
    assert [r[0] for r in found] == [300]


def test_messages_carry_samples(spark, samples):
    every = samples[1]
    back = samples_of(sample_message(every))
    assert key(back.select("ts", "name", "value")) == key(every.select("ts", "name", "value"))


def test_a_stream_without_samples_has_no_runs(spark, tmp_path):
    stream = RuleStream(str(tmp_path), A.RULES, GRID)
    stream.process(spark.createDataFrame([], schemas.METRIC_SAMPLE), 0)
    stream.flush(spark)
    assert stream.intervals(spark).collect() == []
