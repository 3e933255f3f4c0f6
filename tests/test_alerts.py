"""Hold times, inhibition, grouping, schedules and auto-resolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import alerts as A
from tidemark.operators.metrics import Grid

GRID = Grid(step=15, chunk=4)
RULE = A.Rule("SomethingBroken", "WARNING", "worker", 60)
BASE = 1_767_225_600
FIRST = BASE // 15


def active(spark, steps, instance="i"):
    return spark.createDataFrame(
        [(FIRST + s, instance, 1.0) for s in steps], "step bigint, instance string, value double"
    )


def evaluated(spark, steps, rule=RULE):
    return A.evaluate([A.condition(rule, active(spark, steps), ["instance"])], [rule], GRID)


def states(spark, steps, rule=RULE):
    rows = evaluated(spark, steps, rule).collect()
    return {r["step"] - FIRST: r["state"] for r in rows}


def test_condition_must_hold_for_the_whole_time(spark):
    got = states(spark, range(0, 6))
    assert got == {0: "pending", 1: "pending", 2: "pending", 3: "pending", 4: "firing", 5: "firing"}


def test_a_gap_starts_over(spark):
    got = states(spark, [0, 1, 2, 3, 5, 6, 7, 8, 9])
    assert [s for s, state in sorted(got.items()) if state == "firing"] == [9]


def test_runs_cross_chunks(spark):
    got = states(spark, range(0, 40))
    assert [s for s, state in got.items() if state == "pending"] == [0, 1, 2, 3]


def test_zero_hold_fires_at_once(spark):
    got = states(spark, [3], A.Rule("Now", "INFO", "x", 0))
    assert got == {3: "firing"}


def test_intervals(spark):
    rows = A.intervals(evaluated(spark, [0, 1, 2, 3, 4, 5, 10]), GRID)
    got = rows.orderBy("active_at").collect()
    moment = dt.datetime.fromtimestamp(BASE, dt.UTC).replace(tzinfo=None)
    assert got[0]["active_at"] == moment
    assert got[0]["fired_at"] == moment + dt.timedelta(seconds=60)
    assert got[0]["ended_at"] == moment + dt.timedelta(seconds=90)
    assert got[1]["fired_at"] is None


def test_rule_states(spark):
    found = evaluated(spark, range(5))
    rules = (RULE, A.Rule("Quiet", "CRITICAL", "x", 0))

    def at(step):
        return {r["alertname"]: r["state"]
                for r in A.rule_states(spark, found, F.lit(FIRST + step), rules).collect()}

    assert at(1) == {"SomethingBroken": "pending", "Quiet": "inactive"}
    assert at(4) == {"SomethingBroken": "firing", "Quiet": "inactive"}


def test_rules_are_followed_separately(spark):
    other = A.Rule("Other", "CRITICAL", "x", 15)
    found = A.evaluate(
        [A.condition(RULE, active(spark, range(5)), ["instance"]),
         A.condition(other, active(spark, [3, 4]))], [RULE, other], GRID)
    got = {(r["alertname"], r["instance"], r["step"] - FIRST)
           for r in A.firing(found).collect()}
    assert got == {("SomethingBroken", "i", 4), ("Other", "", 4)}


def firing(spark, rows):
    """``rows``: (alertname, component, instance, severity, steps)."""
    flat = [(n, sev, c, i, FIRST + s, FIRST, "firing")
            for n, c, i, sev, steps in rows for s in steps]
    return spark.createDataFrame(
        flat, "alertname string, severity string, component string, instance string, "
              "step bigint, since bigint, state string")


def test_down_consumer_explains_its_own_component_only(spark):
    alerts = firing(spark, [
        ("ConsumerDown", "consumer", "a", "CRITICAL", [1]),
        ("KafkaLagHigh", "consumer", "", "WARNING", [1, 2]),
        ("PostgresUnavailable", "postgres", "", "CRITICAL", [1]),
    ])
    got = {(r["alertname"], r["step"] - FIRST) for r in A.inhibit(alerts).collect()}
    assert got == {("ConsumerDown", 1), ("KafkaLagHigh", 2), ("PostgresUnavailable", 1)}


def test_instances_share_one_group(spark):
    alerts = firing(spark, [("ConsumerDown", "consumer", i, "CRITICAL", [1]) for i in "abc"])
    row = A.group(alerts).collect()
    assert len(row) == 1 and row[0]["alerts"] == 3


def seconds_of(rows):
    return [(r["reason"], int(r["notify_at"].replace(tzinfo=dt.UTC).timestamp()) - BASE) for r in rows]


def test_schedule_first_and_repeat(spark):
    alerts = firing(spark, [("X", "c", "a", "WARNING", range(0, 600))])  # 2.5 hours
    sent = A.schedule(A.group(alerts), GRID).orderBy("notify_at").collect()
    assert seconds_of(sent) == [("first", 10), ("repeat", 3610), ("repeat", 7210)]


def test_critical_route_waits_less_and_repeats_sooner(spark):
    alerts = firing(spark, [("X", "c", "a", "CRITICAL", range(0, 250))])  # 62.5 minutes
    sent = A.schedule(A.group(alerts), GRID).orderBy("notify_at").collect()
    assert seconds_of(sent) == [("first", 5), ("repeat", 1805), ("repeat", 3605)]
    assert {r["route"] for r in sent} == {"critical"}


def test_changed_members_are_announced_at_the_next_interval(spark):
    alerts = firing(spark, [("X", "c", "a", "WARNING", range(0, 40)),
                            ("X", "c", "b", "WARNING", range(6, 40))])
    sent = A.schedule(A.group(alerts), GRID).orderBy("notify_at").collect()
    # b joins 90 s in; looks happen at 10, 70, 130, ...
    assert seconds_of(sent) == [("first", 10), ("changed", 130)]


def test_group_gone_before_the_first_look_is_silent(spark):
    rule_grid = Grid(step=1, chunk=64)
    alerts = firing(spark, [("X", "c", "a", "WARNING", range(0, 5))])
    assert A.schedule(A.group(alerts), rule_grid).count() == 0


def test_auto_resolve(spark):
    def at(s):
        return dt.datetime.fromtimestamp(BASE + s, dt.UTC)
    rows = [("f", at(s)) for s in (0, 60, 180, 301, 301)] + [("g", at(0))]
    got = A.auto_resolve(spark.createDataFrame(rows, "fingerprint string, ts timestamp"))
    seen = sorted((r["fingerprint"], int(r["started_at"].replace(tzinfo=dt.UTC).timestamp()) - BASE,
                   r["updates"], int(r["resolved_at"].replace(tzinfo=dt.UTC).timestamp()) - BASE)
                  for r in got.collect())
    assert seen == [("f", 0, 3, 300), ("f", 301, 1, 421), ("g", 0, 1, 120)]


def test_equal_members_do_not_cancel(spark):
    rows = [("A", "c", "i", "WARNING", 1, 1), ("B", "c", "i", "WARNING", 1, 1)]
    alerts = spark.createDataFrame(
        rows, "alertname string, component string, instance string, severity string, "
              "step bigint, since bigint")
    together = A.group(alerts, by=("component",)).first()["members"]
    alone = A.group(alerts.where("alertname = 'A'"), by=("component",)).first()["members"]
    assert together != alone and together != 0
