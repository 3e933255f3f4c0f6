"""One key holding a third of all rows: results stay whole, groups stay bounded."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import daily, dedupe, eventtime, incidents
from tidemark.operators.running import blocks_of, running

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one customer, and a third repeat one event id."""
    n = F.col("id")
    return spark.range(ROWS).select(
        n.alias("arrival"), F.call_function("div", n, F.lit(1000)).alias("tick"),
        F.when(n % 3 == 0, F.lit("again")).otherwise(F.concat(F.lit("e"), n.cast("string")))
        .alias("event_id"),
        F.when(n % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("c"), (n % 97).cast("string")))
        .alias("customer_id"),
        (20 + n % 231).cast("int").alias("heart_rate"),
        F.timestamp_seconds(1_767_225_600 + n * 20 - F.when(n % 7 == 0, n * 13 % 200_000)
                            .otherwise(0)).alias("event_time"),
    )


def test_hot_id_is_new_once(spark, skewed):
    flagged = dedupe.flag_first_arrivals(skewed)
    counts = flagged.groupBy("is_new").count().collect()
    assert {r["is_new"]: r["count"] for r in counts} == {
        True: ROWS * 2 // 3 + 1, False: ROWS // 3 - 1}
    summary = dedupe.duplicate_summary(skewed).first()
    assert tuple(summary) == (ROWS, ROWS * 2 // 3 + 1, ROWS // 3 - 1)


def test_hot_customer_window_counts_everything(spark, skewed):
    flagged = dedupe.flag_first_arrivals(skewed)
    outcomes = daily.flag_aggregated(eventtime.observe(flagged))
    windows = daily.daily_by_event_time(flagged)
    by_window = outcomes.where("aggregated").groupBy(*daily.KEY).agg(
        F.count(F.lit(1)).alias("n"), F.sum("heart_rate").alias("s"))
    both = windows.join(by_window, list(daily.KEY), "full")
    wrong = both.where(~(F.col("event_count").eqNullSafe(F.col("n"))
                         & F.col("heart_rate_sum").eqNullSafe(F.col("s"))))
    assert wrong.count() == 0 and windows.where("customer_id = 'hot'").count() > 3


def test_watermark_equals_plain_window(spark, skewed):
    plain = Window.orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.select("arrival", F.max("event_time").over(plain).alias("w"))
    got = running(skewed, F.col("event_time"), "g", order=["arrival"],
                  levels=blocks_of(F.col("arrival"), 64))
    assert got.join(want, "arrival").where(~F.col("g").eqNullSafe(F.col("w"))).count() == 0


def test_no_window_groups_a_whole_hot_key(spark, skewed):
    """Windows are partitioned by blocks, and joins carry more than the hot key."""
    frames = [
        eventtime.observe(skewed), dedupe.flag_first_arrivals(skewed),
        daily.daily_by_event_time(dedupe.flag_first_arrivals(skewed)),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line:
                assert "customer_id" not in line.split("windowspecdefinition", 1)[1]
                assert "event_id" not in line.split("windowspecdefinition", 1)[1]


def test_endlessly_repeated_alert(spark):
    n = F.col("id")
    alerts = spark.range(20_000).select(
        n.alias("arrival"), F.lit(0).alias("position"), F.timestamp_seconds(n).alias("received_at"),
        F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), (n % 50).cast("string")))
        .alias("fingerprint"),
        F.lit("T").alias("alert_type"), F.lit("INFO").alias("severity"), F.lit("m").alias("message"),
        F.lit(None).cast("string").alias("source"),
        F.when(n % 1000 == 999, F.lit("RESOLVED")).otherwise(F.lit("FIRING")).alias("status"),
        F.timestamp_seconds(n).alias("created_at"), F.create_map().cast("map<string,string>")
        .alias("labels"),
    )
    order = Window.partitionBy("fingerprint").orderBy("arrival")
    previous = F.lag("status").over(order)
    opened = (F.col("status") == "FIRING") & (F.coalesce(previous, F.lit("RESOLVED")) == "RESOLVED")
    want = alerts.select(opened.cast("int").alias("o")).agg(F.sum("o")).first()[0]
    assert incidents.notification_history(alerts).count() == want
