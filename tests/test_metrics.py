"""Range evaluation and quantiles against brute force, and the counters."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M

GRID = M.Grid(step=15, chunk=8)
BASE = 1_767_225_600  # a whole number of steps


def at(seconds):
    return dt.datetime.fromtimestamp(BASE + seconds, dt.UTC)


def samples(spark, points):
    """``points``: (series, seconds, value)."""
    return spark.createDataFrame(
        [(at(s), name, float(v)) for name, s, v in points],
        "ts timestamp, instance string, value double",
    )


def plain_increase(points, moment, over, extrapolate):
    """points of one series as (seconds, value)."""
    seen = sorted(p for p in points if moment - over < p[0] <= moment)
    if len(seen) < 2:
        return None
    grown = sum(b if b < a else b - a for (_, a), (_, b) in zip(seen, seen[1:], strict=False))
    if not extrapolate:
        return grown
    first, last = seen[0][0], seen[-1][0]
    length = last - first
    gap = length / (len(seen) - 1)
    head, tail = first - (moment - over), moment - last
    if head >= gap * 1.1:
        head = gap / 2
    if grown > 0 and seen[0][1] >= 0:
        head = min(head, length * seen[0][1] / grown)
    if tail >= gap * 1.1:
        tail = gap / 2
    return grown * (length + head + tail) / length


@pytest.mark.parametrize("extrapolate", [True, False])
def test_increase_matches_brute_force(spark, extrapolate):
    rng = random.Random(7)
    points = []
    for name in ("a", "b", "c"):
        value, clock = 0, rng.randrange(5)
        for _ in range(150):
            clock += rng.choice([7, 15, 15, 15, 40, 400])
            value = 0 if rng.random() < 0.05 else value + rng.randrange(20)
            points.append((name, clock, value))
    over = 300
    got = {
        (r["instance"], r["step"]): r["value"]
        for r in M.increase(samples(spark, points), ["instance"], over, GRID,
                            extrapolate=extrapolate).collect()
    }
    want = {}
    for name in ("a", "b", "c"):
        series = [(s, v) for n, s, v in points if n == name]
        for moment in range(0, series[-1][0] + over + 60, 15):
            value = plain_increase(series, moment, over, extrapolate)
            if value is not None:
                want[(name, (BASE + moment) // 15)] = value
    assert set(got) == set(want)
    for key, value in want.items():
        assert math.isclose(got[key], value, rel_tol=1e-9, abs_tol=1e-9), key


def test_counter_reset_counts_from_zero(spark):
    rows = samples(spark, [("a", 15, 10), ("a", 30, 20), ("a", 45, 3), ("a", 60, 5)])
    last = M.increase(rows, ["instance"], 300, GRID, extrapolate=False).where(
        F.col("eval_ts") == F.lit(at(60))).first()
    assert last["value"] == 10 + 3 + 2


def test_rate_needs_two_samples(spark):
    assert M.rate(samples(spark, [("a", 15, 10)]), ["instance"], 300, GRID).count() == 0


def test_instant_value_goes_stale(spark):
    rows = samples(spark, [("a", 20, 1), ("a", 31, 2), ("b", 30, 9)])
    got = {(r["instance"], r["step"] * 15 - BASE): r["value"]
           for r in M.instant(rows, ["instance"], GRID, 60).collect()}
    assert got == {("a", 30): 1, ("a", 45): 2, ("a", 60): 2, ("a", 75): 2, ("a", 90): 2,
                   ("b", 30): 9, ("b", 45): 9, ("b", 60): 9, ("b", 75): 9}


def test_instant_matches_brute_force_across_chunks(spark):
    rng = random.Random(3)
    points = sorted({("a", rng.randrange(4000)): rng.randrange(50) for _ in range(60)}.items())
    series = [(s, v) for (_, s), v in points]
    got = {r["step"]: r["value"] for r in
           M.instant(samples(spark, [("a", s, v) for s, v in series]), ["instance"], GRID, 300)
           .collect()}
    want = {}
    for moment in range(0, 4500, 15):
        seen = [p for p in series if moment - 300 < p[0] <= moment]
        if seen:
            want[(BASE + moment) // 15] = max(seen)[1]
    assert got == want


def test_absent_lists_steps_without_any_series(spark):
    rows = samples(spark, [("a", 15, 1), ("b", 60, 1), ("a", 75, 1)])
    steps = M.spine(M.step_bounds(rows, GRID), GRID)
    missing = M.absent(steps, M.instant(rows, ["instance"], GRID, 15))
    assert sorted(r["step"] * 15 - BASE for r in missing.collect()) == [30, 45]
    assert steps.count() == 5


def test_range_must_be_whole_steps():
    with pytest.raises(ValueError):
        GRID.steps_in(20)


def buckets(spark, counts, bounds=(0.1, 0.5, 1.0, M.INFINITY)):
    rows = [(1, float(le), float(n)) for le, n in zip(bounds, counts, strict=True)]
    return spark.createDataFrame(rows, "step bigint, le double, value double")


@pytest.mark.parametrize("counts,q,expected", [
    ((10, 10, 10, 10), 0.5, 0.05),       # inside the first bucket, from zero
    ((0, 10, 10, 10), 0.5, 0.3),         # a middle bucket
    ((0, 0, 5, 10), 0.95, 1.0),          # the +Inf bucket: highest finite bound
    ((2, 4, 8, 8), 0.75, 0.75),
    ((0, 0, 0, 0), 0.5, None),
])
def test_quantile_buckets(spark, counts, q, expected):
    got = M.quantile(buckets(spark, counts), q, by=["step"]).first()["value"]
    assert got is None if expected is None else math.isclose(got, expected)


def test_histogram_is_cumulative_and_complete(spark):
    values = spark.createDataFrame([(v,) for v in (0.001, 0.002, 0.3, 5.0, 9.0)], "s double")
    rows = M.histogram(values, F.col("s")).orderBy("le").collect()
    assert [r["le"] for r in rows][:2] == [0.001, 0.005] and len(rows) == 12
    assert [r["count"] for r in rows] == [1, 2, 2, 2, 2, 2, 2, 3, 3, 3, 4, 5]


def test_backlog_is_never_negative(spark):
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 3), ("t", 2, 4)],
                                 "topic string, partition int, end_offset bigint")
    at_ = spark.createDataFrame([("t", 0, 4), ("t", 1, 5)],
                                "topic string, partition int, position bigint")
    assert {r["partition"]: r["lag"] for r in M.backlog(ends, at_).collect()} == {0: 6, 1: 0}


def test_share_is_clamped(spark):
    def one(v):
        return spark.createDataFrame([(1, at(0), v)], "step bigint, eval_ts timestamp, value double")
    assert M.share(one(0.0), one(0.0)).first()["value"] == 0.0
    assert M.share(one(1.0), one(3.0)).first()["value"] == 0.25
