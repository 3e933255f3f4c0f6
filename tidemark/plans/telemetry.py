"""Metric samples derived from ``events``, and the rules and reports over them.

Three instances (the source partitions) are scraped every ten minutes; their
counters restart at midnight. Ranges, hold times and limits are scaled to that
scrape interval and are parameters everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.functions.numbers import clamp_min
from tidemark.names import (
    PROCESSED, FAILED, DEAD_LETTERED, ABNORMAL, LATE, LATENCY_BUCKET,
    WATERMARK_LAG, WINDOWS_OPEN, WINDOWS_FINALIZED, PARTITION_LAG, DUPLICATES, UP, SINK_UP,
)
from tidemark.operators import alerts as A
from tidemark.operators import metrics as M
from tidemark.plans.readings import TOPIC, _reading_columns, events
from tidemark.session import stage

SCRAPE_SECONDS = 600
GRID = M.Grid(step=SCRAPE_SECONDS)
JOB = "consumer"
BUCKET_BOUNDS = M.LATENCY_BOUNDS


def le_text(bound: float) -> str:
    return "+Inf" if bound == M.INFINITY else repr(bound)


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter and gauge values per instance and scrape, one column per series."""
    rows = events(spark, sf_dir).select(
        *_reading_columns(), "event_type", (F.col("value") / 100.0).alias("seconds")
    )
    valid = F.col("heart_rate").between(20, 250)
    backdated = F.col("event_time") < F.col("sent_at")
    far = F.col("event_time") < times.shift_seconds(F.col("sent_at"), -600)
    scraped = GRID.first_step(F.col("sent_at"))
    per_scrape = rows.groupBy(
        F.col("src_partition"), scraped.alias("scrape")
    ).agg(
        F.count_if(valid).alias(PROCESSED),
        F.count_if(~valid).alias(DEAD_LETTERED),
        F.count_if(valid & ~F.col("heart_rate").between(60, 100)).alias(ABNORMAL),
        F.count_if(valid & backdated & ~far).alias("late_true"),
        F.count_if(valid & far).alias("late_false"),
        *[F.count_if(F.col("seconds") <= le).alias(f"le_{i}")
          for i, le in enumerate([*BUCKET_BOUNDS, M.INFINITY])],
        F.max("heart_rate").alias("peak"),
        F.max(F.unix_micros("sent_at")).alias("last_seen"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "signup").alias("signups"),
    )
    counters = [PROCESSED, DEAD_LETTERED, ABNORMAL, "late_true", "late_false", "signups",
                *[f"le_{i}" for i in range(len(BUCKET_BOUNDS) + 1)]]
    day = F.call_function("div", F.col("scrape"), F.lit(86_400 // SCRAPE_SECONDS).cast("bigint"))
    since_restart = (
        Window.partitionBy("src_partition", day).orderBy("scrape")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return per_scrape.withColumns(
        {name: F.sum(name).over(since_restart) for name in counters}
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long sample table: (ts, name, labels, value)."""
    ts = GRID.time(F.col("scrape"))
    instance = F.concat(F.lit("instance-"), F.col("src_partition").cast("string"))

    def sample(name: str, value: Column, *labels: str | Column) -> Column:
        plain = [F.lit(part) if isinstance(part, str) else part for part in labels]
        return F.struct(
            F.lit(name).alias("name"),
            F.create_map(F.lit("job"), F.lit(JOB), F.lit("instance"), instance, *plain)
            .alias("labels"),
            value.cast("double").alias("value"),
        )

    lag = (F.unix_micros(ts) - F.col("last_seen")) / 1e6 + 300
    produced = [
        sample(PROCESSED, F.col(PROCESSED)),
        sample(DEAD_LETTERED, F.col(DEAD_LETTERED)),
        sample(FAILED, F.col(DEAD_LETTERED), "reason", "validation"),
        sample(ABNORMAL, F.col(ABNORMAL)),
        sample(LATE, F.col("late_true"), "aggregated", "true"),
        sample(LATE, F.col("late_false"), "aggregated", "false"),
        *[sample(LATENCY_BUCKET, F.col(f"le_{i}"), "le", le_text(le))
          for i, le in enumerate([*BUCKET_BOUNDS, M.INFINITY])],
        sample(WATERMARK_LAG, lag),
        sample(WINDOWS_OPEN, F.col("signups")),
        sample(WINDOWS_FINALIZED, F.col("late_true") + F.col("late_false")),
        sample(PARTITION_LAG, F.col("peak") * 20,
               "topic", F.lit(TOPIC), "partition", F.col("src_partition").cast("string")),
        sample(UP, F.when(F.col("views") > 0, 1).otherwise(0)),
        sample(SINK_UP, F.when(F.col("peak") > 60, 1).otherwise(0)),
    ]
    return scrapes(spark, sf_dir).select(ts.alias("ts"), F.inline(F.array(*produced)))


SERIES = ("name", "instance", "label")


def _label() -> Column:
    """The label that tells series of one metric and instance apart."""
    labels = F.col("labels")
    return F.coalesce(*[labels[n] for n in ("aggregated", "le", "reason", "partition")])


def rates(
    samples: DataFrame, names: Sequence[str], over: int, grid: M.Grid = GRID
) -> DataFrame:
    """rate() of every series of the named counters at every step."""
    return M.rate(M.select_metrics(samples, names, _label()), SERIES, over, grid)


def gauges(
    samples: DataFrame, names: Sequence[str], lookback: int, grid: M.Grid = GRID
) -> DataFrame:
    """Current value of every series of the named metrics at every step."""
    return M.instant(M.select_metrics(samples, names, _label()), SERIES, grid, lookback)


def named(values: DataFrame, name: str) -> DataFrame:
    return values.where(F.col("name") == name)


def total(values: DataFrame, name: str, how: str = "sum") -> DataFrame:
    return M.across(named(values, name), how)


def bucket_rates(evaluated: DataFrame) -> DataFrame:
    """sum by (le) of evaluated bucket rates, with numeric ``le``."""
    summed = M.across(named(evaluated, LATENCY_BUCKET), by=("label",))
    label = F.col("label")
    bound = F.when(label == "+Inf", F.lit(M.INFINITY)).otherwise(label.try_cast("double"))
    return summed.withColumn("le", bound)


def latency_quantile(evaluated: DataFrame, q: float) -> DataFrame:
    return M.quantile(bucket_rates(evaluated), q)


def dead_letter_share(evaluated: DataFrame) -> DataFrame:
    """Dead-lettered share of all messages, as one conditional aggregation per step."""
    def part(name: str) -> Column:
        return F.sum(F.when(F.col("name") == name, F.col("value")))

    letters, processed = F.col("__letters"), F.col("__processed")
    return (
        evaluated.where(F.col("name").isin(DEAD_LETTERED, PROCESSED))
        .groupBy("step", "eval_ts")
        .agg(part(DEAD_LETTERED).alias("__letters"), part(PROCESSED).alias("__processed"))
        .where(letters.isNotNull() & processed.isNotNull())
        .select("step", "eval_ts",
                (letters / clamp_min(letters + processed, 0.001)).alias("value"))
    )


def throughput_summary(
    samples: DataFrame, at_step: Column, *, short: int, long: int, lookback: int,
    grid: M.Grid = GRID,
) -> DataFrame:
    """The ten named values of the throughput report at one evaluation step."""
    reach = max(short, long, lookback)
    visible = M.seen_at(samples, at_step, reach, grid)

    def at(values: DataFrame) -> DataFrame:
        return values.where(F.col("step") == at_step)

    counters = at(rates(visible, [PROCESSED, FAILED, ABNORMAL, LATE], short, grid))
    buckets = at(rates(visible, [LATENCY_BUCKET], long, grid))
    current = at(gauges(visible, [WATERMARK_LAG, WINDOWS_OPEN, UP], lookback, grid))
    # Each evaluation is aggregated once, by metric; the labels and functions follow from its name.
    per_second = {PROCESSED: "processed/sec", FAILED: "failed/sec", ABNORMAL: "abnormal/sec", LATE: "late/sec"}
    now = {WATERMARK_LAG: "watermark lag (s)", WINDOWS_OPEN: "windows open", UP: "consumer instances"}

    def labelled(values: DataFrame, labels: dict[str, str], value: Column) -> DataFrame:
        names = F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])
        found = values.groupBy("name").agg(value.cast("double").alias("value")).where("value IS NOT NULL")
        return found.select(names[F.col("name")].alias("name"), "value")

    healthy = F.count_if(F.col("value") == 1)
    current_value = (
        F.when(F.first("name") == WATERMARK_LAG, F.max("value"))
        .when(F.first("name") == WINDOWS_OPEN, F.sum("value"))
        .otherwise(F.when(healthy > 0, healthy))
    )
    percent = F.round(F.col("q") * 100).cast("int").cast("string")
    latency = M.quantiles(bucket_rates(buckets), (0.50, 0.95, 0.99)).select(
        F.concat(F.lit("p"), percent, F.lit(" latency (s)")).alias("name"), "value")
    return A.union_all([
        latency, labelled(counters, per_second, F.sum("value")), labelled(current, now, current_value)])


def panels(
    samples: DataFrame, *, short: int, long: int, lookback: int, grid: M.Grid = GRID
) -> dict[str, DataFrame]:
    """One frame (panel, legend, eval_ts, value) per dashboard panel.

    The three evaluations behind them are written once and read per panel.
    """

    def feed(title: str, frames: dict[str, DataFrame]) -> DataFrame:
        return A.union_all([
            frame.select(F.lit(title).alias("panel"), F.lit(legend).alias("legend"),
                         "eval_ts", "value")
            for legend, frame in frames.items()
        ])

    def labelled(title: str, frame: DataFrame, prefix: str, label: str) -> DataFrame:
        return frame.select(
            F.lit(title).alias("panel"), F.concat(F.lit(prefix), label).alias("legend"),
            "eval_ts", "value",
        )

    current = stage(gauges(
        samples,
        [PROCESSED, DEAD_LETTERED, ABNORMAL, LATE, WATERMARK_LAG, WINDOWS_OPEN,
         WINDOWS_FINALIZED],
        lookback, grid), "panel-values")
    recent = stage(rates(samples, [PROCESSED, FAILED], short, grid), "panel-rates")
    slow = stage(rates(samples, [LATENCY_BUCKET, LATE], long, grid), "panel-slow-rates")
    late = M.across(named(slow, LATE), by=("label",)).withColumn(
        "value", F.col("value") * F.lit(float(long)))
    return {
        "Messages processed": feed("Messages processed", {"processed": total(current, PROCESSED)}),
        "DLQ events": feed("DLQ events", {"dlq": total(current, DEAD_LETTERED)}),
        "Abnormal events": feed("Abnormal events", {"abnormal": total(current, ABNORMAL)}),
        "Late events": feed("Late events", {"late": total(current, LATE)}),
        "Messages per second": feed("Messages per second", {
            "processed/sec": total(recent, PROCESSED), "failed/sec": total(recent, FAILED),
        }),
        "Processing latency": M.quantiles(bucket_rates(slow), (0.50, 0.95, 0.99), by=["step", "eval_ts"]).select(
            F.lit("Processing latency").alias("panel"),
            F.concat(F.lit("p"), F.round(F.col("q") * 100).cast("int").cast("string")).alias("legend"), "eval_ts", "value"),
        "Watermark lag": labelled(
            "Watermark lag", named(current, WATERMARK_LAG), "lag ", "instance"),
        "Late events by aggregate outcome": labelled(
            "Late events by aggregate outcome", late, "aggregated=", "label"),
        "Windows": feed("Windows", {
            "open": total(current, WINDOWS_OPEN),
            "finalized (cumulative)": total(current, WINDOWS_FINALIZED),
        }),
    }


def alert_conditions(
    samples: DataFrame, *, over: int, lookback: int, grid: M.Grid = GRID, job: str = JOB,
    lag_limit: float = A.LAG_LIMIT, latency_limit: float = A.LATENCY_LIMIT,
    share_limit: float = A.DEAD_LETTER_LIMIT, watermark_limit: float = A.WATERMARK_LAG_LIMIT,
    bounds: DataFrame | None = None,
) -> list[DataFrame]:
    """Steps at which the condition of each built-in rule holds.

    ``bounds`` (lo, hi) are the steps at which missing series count; all that the samples span
    if not given.
    """
    bounds = M.step_bounds(samples, grid) if bounds is None else bounds
    evaluated = stage(
        rates(samples, [DEAD_LETTERED, PROCESSED, LATENCY_BUCKET], over, grid), "rule-rates")
    current = stage(
        gauges(samples.where(F.col("labels")["job"] == job),
               [UP, SINK_UP, PARTITION_LAG, WATERMARK_LAG], lookback, grid), "rule-values")
    up = named(current, UP)
    missing = M.absent(M.spine(bounds, grid), up)
    down = up.where(F.col("value") == 0).select("step", "instance", "value").unionByName(
        missing.select("step", F.lit("").alias("instance"), "value")
    )
    lag = total(current, PARTITION_LAG)
    behind = total(current, WATERMARK_LAG, "max")
    latency = latency_quantile(evaluated, 0.95)
    value = F.col("value")
    return [
        A.condition(A.CONSUMER_DOWN, down, ["instance"]),
        A.condition(A.SINK_UNAVAILABLE, named(current, SINK_UP).where(value == 0), ["instance"]),
        A.condition(A.LAG_HIGH, lag.where(value > lag_limit)),
        A.condition(A.LATENCY_HIGH, latency.where(value > latency_limit)),
        A.condition(A.DEAD_LETTERS_HIGH, dead_letter_share(evaluated).where(value > share_limit)),
        A.condition(A.WATERMARK_STUCK, behind.where(value > watermark_limit)),
    ]


def evaluate_rules(
    samples: DataFrame, rules: Sequence[A.Rule] = A.RULES, *, over: int = 300,
    lookback: int = 300, grid: M.Grid = M.Grid(), job: str = JOB, **limits: float,
) -> DataFrame:
    """Pending and firing alert instances of all rules at every step."""
    conditions = alert_conditions(
        samples, over=over, lookback=lookback, grid=grid, job=job, **limits)
    return A.evaluate(conditions, rules, grid)
