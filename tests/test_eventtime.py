"""Watermark, lateness, windows and finalization, against a row-by-row model."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from model import replay
from pyspark.sql import functions as F

from tidemark import EventTimePolicy
from tidemark.functions import times
from tidemark.operators import daily, dedupe, eventtime
from tidemark.operators.enrich import with_status
from tidemark.operators.running import blocks_of, running

SCHEMA = ("arrival bigint, tick bigint, event_id string, customer_id string, heart_rate int, "
          "event_time timestamp")


def utc(day, hour=0, minute=0, second=0, month=8):
    return dt.datetime(2026, month, day, hour, minute, second, tzinfo=dt.UTC)


def frame(spark, events, tick=1):
    """``events``: (customer, rate, time[, id]) in arrival order."""
    rows = []
    for index, (customer, rate, when, *given) in enumerate(events):
        event_id = given[0] if given else f"id-{index}"
        rows.append((index, index // tick, event_id, customer, rate, when))
    return spark.createDataFrame(rows, SCHEMA), rows


def judged(spark, events, tick=1, policy=EventTimePolicy()):
    df, rows = frame(spark, events, tick)
    tagged = daily.flag_aggregated(
        dedupe.flag_first_arrivals(eventtime.observe(df, policy=policy)), policy
    )
    windows = daily.daily_by_event_time(dedupe.flag_first_arrivals(df), policy)
    flags = {r["arrival"]: r for r in tagged.collect()}
    return flags, windows.collect(), rows


def test_first_event_is_on_time(spark):
    flags, windows, _ = judged(spark, [("a", 70, utc(30, 12))])
    assert not flags[0]["is_late"] and flags[0]["lateness_seconds"] is None
    assert flags[0]["aggregated"] and flags[0]["watermark_before"] is None
    assert windows[0]["event_count"] == 1


def test_event_behind_watermark_is_late(spark):
    flags, _, _ = judged(spark, [("a", 70, utc(30, 12)), ("a", 70, utc(30, 11))])
    assert flags[1]["is_late"] and flags[1]["lateness_seconds"] == 3300.0
    assert flags[1]["late_outcome"] == "aggregated"


def test_moderate_disorder_is_not_late(spark):
    flags, _, _ = judged(spark, [("a", 70, utc(30, 12, 10)), ("a", 70, utc(30, 12, 8))])
    assert not flags[1]["is_late"]


def test_equal_to_watermark_is_not_late(spark):
    flags, _, _ = judged(spark, [("a", 70, utc(30, 12)), ("a", 70, utc(30, 11, 55)),
                                 ("a", 70, utc(30, 11, 54, 59))])
    assert [flags[i]["is_late"] for i in range(3)] == [False, False, True]
    assert flags[2]["lateness_seconds"] == 1.0


def test_window_follows_event_time_not_arrival(spark):
    _, windows, _ = judged(spark, [("a", 80, utc(31, 1)), ("a", 60, utc(30, 23))])
    assert {w["window_start"].day: w["event_count"] for w in windows} == {30: 1, 31: 1}


def test_window_finalizes_once_watermark_passes_grace(spark):
    _, windows, _ = judged(spark, [("a", 70, utc(30, 12)), ("a", 80, utc(31, 6))])
    state = {w["window_start"].day: w["is_finalized"] for w in windows}
    assert state == {30: True, 31: False}


def test_watermark_exactly_at_limit_keeps_window_open(spark):
    # Watermark = 01:00:00 on the 31st = end + lateness: not past it.
    _, windows, _ = judged(spark, [("a", 70, utc(30, 12)), ("a", 80, utc(31, 1, 5))])
    assert not any(w["is_finalized"] for w in windows)


def test_too_late_event_leaves_finalized_window_alone(spark):
    flags, windows, _ = judged(
        spark, [("a", 70, utc(30, 12)), ("a", 80, utc(31, 6)), ("a", 200, utc(30, 13))]
    )
    assert flags[2]["late_outcome"] == "finalized" and not flags[2]["aggregated"]
    day30 = next(w for w in windows if w["window_start"].day == 30)
    assert (day30["event_count"], day30["average_heart_rate"]) == (1, 70.0)


def test_unopened_old_window_is_opened_by_any_event(spark):
    flags, windows, _ = judged(
        spark, [("a", 70, utc(30, 12)), ("b", 99, utc(10, 12)), ("b", 50, utc(10, 13))]
    )
    assert flags[1]["late_outcome"] == "aggregated" and flags[2]["late_outcome"] == "finalized"
    old = next(w for w in windows if w["customer_id"] == "b")
    assert old["is_finalized"] and old["finalized_tick"] == 1 and old["event_count"] == 1


def test_customers_have_separate_windows(spark):
    _, windows, _ = judged(spark, [("a", 70, utc(30, 12)), ("b", 180, utc(30, 12))])
    assert {w["customer_id"]: w["abnormal_count"] for w in windows} == {"a": 0, "b": 1}


def test_redelivery_counts_once_but_moves_watermark(spark):
    event = ("a", 70, utc(30, 12), "same")
    flags, windows, _ = judged(spark, [event, event, event])
    assert windows[0]["event_count"] == 1
    assert [flags[i]["is_new"] for i in range(3)] == [True, False, False]


def test_four_readings(spark):
    _, windows, _ = judged(spark, [("a", r, utc(30, 12)) for r in (60, 80, 100, 190)])
    w = windows[0]
    assert (w["event_count"], w["minimum_heart_rate"], w["maximum_heart_rate"],
            w["average_heart_rate"], w["abnormal_count"]) == (4, 60, 190, 107.5, 1)


def test_offset_is_converted_before_choosing_the_window(spark):
    text = spark.createDataFrame([("2026-08-31T01:30:00+03:00",)], "t string")
    start = text.select(times.window_start(times.parse_iso_with_offset(F.col("t")))).first()[0]
    assert start.day == 30


@pytest.mark.parametrize("order", [(0, 3, 1, 7), (7, 1, 3, 0)])
def test_final_watermark_does_not_depend_on_order(spark, order):
    df, _ = frame(spark, [("a", 70, utc(30, 12, m)) for m in order])
    last = eventtime.tick_ledger(df).orderBy(F.desc("tick")).first()
    assert last["watermark_after"] == utc(30, 12, 2).replace(tzinfo=None)


@pytest.mark.parametrize("seed,tick", [(1, 1), (2, 7), (3, 40), (4, 500)])
def test_random_streams_match_row_by_row_model(spark, seed, tick):
    rng = random.Random(seed)
    base = utc(1, month=1)
    events, moment = [], base
    for index in range(400):
        moment += dt.timedelta(seconds=rng.randrange(0, 2400))
        back = rng.choice([0, 0, 0, 60, 600, 7200, 90_000, 400_000])
        when = max(base, moment - dt.timedelta(seconds=back))
        events.append((f"c{rng.randrange(4)}", rng.randrange(20, 251), when, f"id-{index}"))
        if rng.random() < 0.1:
            events.append(rng.choice(events))
    flags, windows, rows = judged(spark, events, tick)
    expected, expected_windows = replay(rows)
    for arrival, want in expected.items():
        got = flags[arrival]
        assert got["is_late"] == want["late"], arrival
        assert got["lateness_seconds"] == want["behind"], arrival
        assert got["is_new"] == want["new"], arrival
        assert got["aggregated"] == want["aggregated"], arrival
    got_windows = {
        (w["customer_id"], w["window_start"].replace(tzinfo=dt.UTC)):
        (w["event_count"], w["heart_rate_sum"], w["minimum_heart_rate"],
         w["maximum_heart_rate"], w["finalized_tick"])
        for w in windows
    }
    assert got_windows == {
        key: (len(s["rates"]), sum(s["rates"]), min(s["rates"]), max(s["rates"]), s["closed_at"])
        for key, s in expected_windows.items()
    }


def test_restored_state_merges(spark):
    stored = spark.createDataFrame(
        [("a", utc(30), 4, 300, 60, 90, 0)],
        "customer_id string, window_start timestamp, event_count bigint, heart_rate_sum bigint, "
        "minimum_heart_rate int, maximum_heart_rate int, abnormal_count bigint",
    )
    df, _ = frame(spark, [("a", 100, utc(30, 12))])
    merged = daily.merge_states(daily.fold(daily.assign_window(df)), stored).withColumn(
        "average", daily.average()
    ).first()
    assert (merged["event_count"], merged["maximum_heart_rate"], merged["average"]) == (5, 100, 80.0)


def test_restored_finalized_window_refuses(spark):
    df, _ = frame(spark, [("a", 100, utc(30, 12)), ("b", 100, utc(30, 12))])
    state = spark.createDataFrame(
        [("a", utc(30), True)], "customer_id string, window_start timestamp, is_finalized boolean"
    )
    accepted = daily.gate(daily.assign_window(df), state)
    assert {r["customer_id"]: r["accepted"] for r in accepted.collect()} == {"a": False, "b": True}


@pytest.mark.parametrize("how,inclusive", [("max", False), ("max", True), ("sum", True), ("min", False)])
def test_running_equals_plain_window(spark, how, inclusive):
    from pyspark.sql import Window

    rows = spark.range(3000).select(
        (F.col("id") * 7 % 3001).alias("pos"), F.xxhash64("id").alias("v"),
        (F.col("id") % 3 == 0).cast("int").alias("g"),
    ).withColumn("v", F.pmod("v", F.lit(1000)))
    frame_end = 0 if inclusive else -1
    for part in ((), ("g",)):
        w = Window.partitionBy(*part).orderBy("pos").rowsBetween(Window.unboundedPreceding, frame_end)
        plain = {"max": F.max, "min": F.min, "sum": F.sum}[how]("v").over(w)
        if how == "sum":
            plain = F.coalesce(plain, F.lit(0))
        got = running(rows, F.col("v"), "r", order=["pos"], levels=blocks_of(F.col("pos"), 16),
                      how=how, partition_by=part, inclusive=inclusive)
        both = got.join(rows.select("pos", plain.alias("want")), "pos")
        assert both.where(~F.col("r").eqNullSafe(F.col("want"))).count() == 0
        assert both.count() == 3000


def test_carry_and_source_partition_options(spark):
    df, _ = frame(spark, [("a", 70, utc(30, 12))])
    late = eventtime.observe(df, carry=F.lit(utc(30, 13))).first()
    assert late["is_late"] and late["lateness_seconds"] == 3300.0
    two, _ = frame(spark, [("a", 70, utc(30, 12)), ("b", 70, utc(30, 10)), ("b", 70, utc(30, 9))])
    flags = eventtime.observe(two, partition_by=["customer_id"]).orderBy("arrival").collect()
    assert [r["is_late"] for r in flags] == [False, False, True]


def test_status_bounds(spark):
    rates = [45, 59, 60, 72, 100, 101, 180]
    got = with_status(spark.createDataFrame([(r,) for r in rates], "heart_rate int")).collect()
    assert [r["status"] for r in got] == ["ABNORMAL"] * 2 + ["NORMAL"] * 3 + ["ABNORMAL"] * 2


def test_policy_rejects_negative_values():
    with pytest.raises(ValueError):
        EventTimePolicy(out_of_orderness=-1)
