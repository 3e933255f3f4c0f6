"""Pipeline metrics: counters, histograms, backlog, and range evaluation of series.

Samples are long: (ts, name, labels, value). Evaluation runs on a grid of steps,
addressed by step number = time / step. Series are cut into chunks of steps, and
samples that the next chunk's first evaluations can still see are handed to it
too, so one long or busy series is spread over many tasks and no group is longer
than a chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import clamp_min

# Upper bounds of the processing-time histogram, in seconds.
LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)

INFINITY = float("inf")
RANK_TOLERANCE = 1e-12


# -- Aggregations over tagged batches ------------------------------------------


def delivery_counters() -> dict[str, Column]:
    """Counter name to condition, over deliveries tagged with the late policy."""
    late = F.col("is_late")
    return {
        "processed": F.lit(True),
        "abnormal": F.col("is_new") & (F.col("status") == "ABNORMAL"),
        "duplicates": ~F.col("is_new"),
        "late_aggregated": late & (F.col("late_outcome") == "aggregated"),
        "late_finalized": late & (F.col("late_outcome") == "finalized"),
        "late_duplicate": late & (F.col("late_outcome") == "duplicate"),
    }


def count_by(df: DataFrame, counters: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One conditional aggregation for all counters, optionally per ``by``."""
    aggregates = [F.count_if(condition).alias(name) for name, condition in counters.items()]
    return df.groupBy(*by).agg(*aggregates)


def failure_counters() -> dict[str, Column]:
    return {
        "failed_decode": F.col("error_type") == "DECODE_ERROR",
        "failed_validation": F.col("error_type") == "VALIDATION_ERROR",
        "dead_lettered": ~F.col("is_valid"),
    }


def histogram(
    df: DataFrame, value: Column, bounds: Sequence[float] = LATENCY_BOUNDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Cumulative counts per upper bound ``le``, ending with +Inf."""
    limits = [*bounds, INFINITY]
    counted = df.groupBy(*by).agg(
        *[F.count_if(value <= F.lit(le)).alias(f"__le{i}") for i, le in enumerate(limits)]
    )
    pairs = F.array(*[
        F.struct(F.lit(float(le)).alias("le"), F.col(f"__le{i}").alias("count"))
        for i, le in enumerate(limits)
    ])
    return counted.select(*by, F.inline(pairs))


def backlog(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Messages not yet consumed per topic partition, never below zero.

    ``ends`` has end_offset, ``positions`` has position; a partition without a
    position yet is left out.
    """
    return ends.join(positions, ["topic", "partition"]).select(
        "topic", "partition",
        F.greatest(F.lit(0).cast("bigint"), F.col("end_offset") - F.col("position")).alias("lag"),
    )


def end_offsets(messages: DataFrame) -> DataFrame:
    """Offset after the last message of every topic partition."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset")
    )


def load_share(df: DataFrame, by: str = "src_partition") -> DataFrame:
    """Rows and share of all rows per partition: shows key skew."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("events"))
    total = F.sum("events").over(Window.partitionBy())
    return counts.withColumn("share", F.col("events") / total)


# -- Series selection ------------------------------------------------------------


def select_series(
    samples: DataFrame, name: str, labels: Sequence[str] = (),
    matching: Mapping[str, str] | None = None,
) -> DataFrame:
    """Samples of one metric whose labels match, with ``labels`` as columns."""
    rows = samples.where(F.col("name") == name)
    for label, wanted in (matching or {}).items():
        rows = rows.where(F.col("labels")[label] == wanted)
    return rows.select(
        "ts", *[F.coalesce(F.col("labels")[n], F.lit("")).alias(n) for n in labels], "value"
    )


def select_metrics(
    samples: DataFrame, names: Sequence[str], label: Column,
    matching: Mapping[str, str] | None = None,
) -> DataFrame:
    """Samples of several metrics as series (name, instance, label).

    One evaluation then serves all of them with one shuffle.
    """
    rows = samples.where(F.col("name").isin(*names))
    for key, wanted in (matching or {}).items():
        rows = rows.where(F.col("labels")[key] == wanted)
    return rows.select(
        "ts", "name", F.coalesce(F.col("labels")["instance"], F.lit("")).alias("instance"),
        F.coalesce(label, F.lit("")).alias("label"), "value",
    )


def seen_at(samples: DataFrame, at_step: Column, over: int, grid: Grid) -> DataFrame:
    """Only the samples an evaluation at one step can see; prunes before any shuffle."""
    at = F.unix_micros(grid.time(at_step))
    return samples.where(
        (F.unix_micros("ts") <= at) & (F.unix_micros("ts") > at - over * 1_000_000)
    )


# -- Evaluation grid ---------------------------------------------------------------


@dataclass(frozen=True)
class Grid:
    """Evaluation times: every ``step`` seconds, optionally from/to a step number."""

    step: int = 15
    chunk: int = 512

    @property
    def micros(self) -> int:
        return self.step * 1_000_000

    def steps_in(self, seconds: int) -> int:
        if seconds % self.step:
            raise ValueError(f"{seconds} s is not a whole number of {self.step} s steps")
        return seconds // self.step

    def first_step(self, ts: Column) -> Column:
        """First step at or after ``ts``, the first to see a sample taken then."""
        return F.call_function(
            "div", F.unix_micros(ts) + (self.micros - 1), F.lit(self.micros).cast("bigint")
        )

    def last_step(self, ts: Column) -> Column:
        """Last step at or before ``ts``."""
        return F.call_function("div", F.unix_micros(ts), F.lit(self.micros).cast("bigint"))

    def chunk_of(self, step: Column) -> Column:
        return F.call_function("div", step, F.lit(self.chunk).cast("bigint"))

    def time(self, step: Column) -> Column:
        return F.timestamp_micros(step * F.lit(self.micros).cast("bigint"))


def _with_chunks(rows: DataFrame, grid: Grid, reach: int) -> DataFrame:
    """Each row in its own chunk and in those whose evaluations still see it."""
    step = F.col("__step")
    return rows.withColumn(
        "__chunk",
        F.explode(F.sequence(grid.chunk_of(step), grid.chunk_of(step + F.lit(reach - 1)))),
    )


def _spread(buckets: DataFrame, series: Sequence[str], grid: Grid, reach: int) -> DataFrame:
    """Repeat each bucket at the steps of its chunk until the next bucket or ``reach``.

    ``__at`` is the evaluation step; ``__own`` is true on the bucket's own step.
    """
    window = Window.partitionBy(*series, "__chunk").orderBy("__step")
    end = F.least(
        F.lead("__step").over(window) - 1,
        F.col("__step") + (reach - 1),
        F.col("__chunk") * grid.chunk + (grid.chunk - 1),
    )
    return (
        buckets.withColumn("__end", end)
        .withColumn("__at", F.explode(F.sequence(F.col("__step"), F.col("__end"))))
        .withColumn("__own", F.col("__at") == F.col("__step"))
    )


def _inside_chunk(grid: Grid) -> Column:
    return grid.chunk_of(F.col("__at")) == F.col("__chunk")


def increase(
    samples: DataFrame, series: Sequence[str], over: int, grid: Grid = Grid(), *,
    per_second: bool = False, extrapolate: bool = True,
) -> DataFrame:
    """Growth of counters within (t - over, t] at every evaluation step t.

    A drop in value is a restart from zero. At least two samples are needed.
    With ``extrapolate`` the growth between the first and last sample is extended
    towards the edges of the range: fully where a sample lies within 1.1 average
    intervals of the edge, by half an interval otherwise, and never to before the
    counter would have been zero. With ``per_second`` the result is a rate.
    """
    reach = grid.steps_in(over)
    part = [*series, "__chunk"]
    rows = _with_chunks(samples.withColumn("__step", grid.first_step(F.col("ts"))), grid, reach)
    previous = F.lag("value").over(Window.partitionBy(*part).orderBy("ts"))
    rows = rows.withColumn("__previous", previous).withColumn(
        "__delta",
        F.when(F.col("__previous").isNull(), F.lit(0.0))
        .when(F.col("value") < F.col("__previous"), F.col("value"))
        .otherwise(F.col("value") - F.col("__previous")),
    )
    buckets = rows.groupBy(*part, "__step").agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum("__delta").alias("__grown"),
        F.min("ts").alias("__first_ts"),
        F.max("ts").alias("__last_ts"),
        F.min_by("value", "ts").alias("__first_value"),
        F.min_by("__delta", "ts").alias("__first_delta"),
    )
    measures = ["__n", "__grown", "__first_ts", "__last_ts", "__first_value", "__first_delta"]
    grown = _spread(buckets, series, grid, reach).withColumns(
        {name: F.when(F.col("__own"), F.col(name)) for name in measures}
    )
    frame = Window.partitionBy(*part).orderBy("__at").rangeBetween(-(reach - 1), 0)
    seen = grown.select(
        *part, "__at",
        F.sum("__n").over(frame).alias("n"),
        F.sum("__grown").over(frame).alias("grown"),
        F.min("__first_ts").over(frame).alias("first_ts"),
        F.max("__last_ts").over(frame).alias("last_ts"),
        F.min_by("__first_value", "__first_ts").over(frame).alias("first_value"),
        F.min_by("__first_delta", "__first_ts").over(frame).alias("first_delta"),
    ).where(_inside_chunk(grid) & (F.col("n") >= 2))
    # The first sample's own step-up happened before the range.
    result = F.col("grown") - F.col("first_delta")
    if extrapolate:
        result = result * _extrapolation(result, grid, over)
    if per_second:
        result = result / F.lit(float(over))
    return seen.select(
        *series, F.col("__at").alias("step"), grid.time(F.col("__at")).alias("eval_ts"),
        result.alias("value"),
    )


def _extrapolation(grown: Column, grid: Grid, over: int) -> Column:
    def seconds(ts: Column) -> Column:
        return F.unix_micros(ts) / F.lit(1e6)

    at = F.col("__at") * F.lit(float(grid.step))
    sampled = seconds(F.col("last_ts")) - seconds(F.col("first_ts"))
    interval = sampled / (F.col("n") - 1)
    before = seconds(F.col("first_ts")) - (at - F.lit(float(over)))
    after = at - seconds(F.col("last_ts"))
    before = F.when(before >= interval * 1.1, interval / 2).otherwise(before)
    to_zero = sampled * F.try_divide(F.col("first_value"), grown)
    before = F.when(
        (grown > 0) & (F.col("first_value") >= 0) & (to_zero < before), to_zero
    ).otherwise(before)
    after = F.when(after >= interval * 1.1, interval / 2).otherwise(after)
    return F.try_divide(sampled + before + after, sampled)


def rate(
    samples: DataFrame, series: Sequence[str], over: int, grid: Grid = Grid(), *,
    extrapolate: bool = True,
) -> DataFrame:
    return increase(samples, series, over, grid, per_second=True, extrapolate=extrapolate)


def instant(
    samples: DataFrame, series: Sequence[str], grid: Grid = Grid(), lookback: int = 300
) -> DataFrame:
    """Latest value of each series at every step, while younger than ``lookback``."""
    reach = grid.steps_in(lookback)
    rows = _with_chunks(samples.withColumn("__step", grid.first_step(F.col("ts"))), grid, reach)
    buckets = rows.groupBy(*series, "__chunk", "__step").agg(
        F.max_by("value", "ts").alias("value")
    )
    return (
        _spread(buckets, series, grid, reach)
        .where(_inside_chunk(grid))
        .select(*series, F.col("__at").alias("step"),
                grid.time(F.col("__at")).alias("eval_ts"), "value")
    )


def across(
    values: DataFrame, how: str = "sum", by: Sequence[str] = (),
) -> DataFrame:
    """sum / max / min / avg / count over series, per evaluation time."""
    aggregate = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}[how]
    return values.groupBy("step", "eval_ts", *by).agg(
        aggregate("value").cast("double").alias("value")
    )


def spine(bounds: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """All evaluation steps between ``lo`` and ``hi`` (step numbers) of one row."""
    chunks = bounds.select(
        "lo", "hi",
        F.explode(F.sequence(grid.chunk_of(F.col("lo")), grid.chunk_of(F.col("hi")))).alias("__c"),
    )
    first, last = F.col("__c") * grid.chunk, F.col("__c") * grid.chunk + (grid.chunk - 1)
    steps = chunks.select(
        F.explode(F.sequence(F.greatest(F.col("lo"), first), F.least(F.col("hi"), last)))
        .alias("step")
    )
    return steps.withColumn("eval_ts", grid.time(F.col("step")))


def step_bounds(samples: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """One row: first and last evaluation step that the samples span."""
    step = grid.first_step(F.col("ts"))
    return samples.agg(F.min(step).alias("lo"), F.max(step).alias("hi")).where(
        F.col("lo").isNotNull()
    )


def absent(steps: DataFrame, values: DataFrame) -> DataFrame:
    """Steps at which no series has a value; value 1 as in ``absent()``."""
    return steps.join(values.select("step").distinct(), "step", "left_anti").withColumn(
        "value", F.lit(1.0)
    )


def share(
    part: DataFrame, rest: DataFrame, floor: float = 0.001
) -> DataFrame:
    """part / max(part + rest, floor) per evaluation time; both sides must exist."""
    return part.join(
        rest.select("step", F.col("value").alias("__rest")), "step"
    ).select(
        "step", "eval_ts",
        (F.col("value") / clamp_min(F.col("value") + F.col("__rest"), floor)).alias("value"),
    )


def quantiles(
    buckets: DataFrame, qs: Sequence[float], by: Sequence[str] = ("step", "eval_ts"),
    le: str = "le", value: str = "value",
) -> DataFrame:
    """Quantiles ``q`` from cumulative buckets, linear inside the bucket each falls in.

    All of them come from one pass. The first bucket starts at zero; in the +Inf
    bucket the answer is the highest finite bound. NULL when nothing was counted
    or only one bucket exists.
    """
    bound = F.col(le).cast("double")
    ordered = Window.partitionBy(*by).orderBy("__le")
    whole = Window.partitionBy(*by)
    rows = (
        buckets.select(*by, bound.alias("__le"), F.col(value).alias("__count"))
        .withColumn("__below", F.coalesce(F.lag("__count").over(ordered), F.lit(0.0)))
        .withColumn("__lower", F.lag("__le").over(ordered))
        .withColumn("__total", F.max("__count").over(whole))
    )
    lower = F.coalesce("__lower", F.lit(0.0))

    def answer(q: float) -> Column:
        rank = F.lit(float(q)) * F.col("__total")
        inside = F.try_divide(rank - F.col("__below"), F.col("__count") - F.col("__below"))
        found = (
            F.when((F.col("__total") <= 0) | F.col("__total").isNull(), F.lit(None).cast("double"))
            .when(F.col("__le") == F.lit(INFINITY), F.col("__lower"))
            .when(F.col("__lower").isNull() & (F.col("__le") <= 0), F.col("__le"))
            .otherwise(lower + (F.col("__le") - lower) * inside)
        )
        # The bucket the rank falls in is the first one that reaches it. Counts may be
        # sums of rates, whose last digits depend on the order of addition.
        reached = F.when(F.col("__count") >= rank * F.lit(1 - RANK_TOLERANCE), F.col("__le"))
        return F.struct(F.lit(float(q)).alias("q"), F.min_by(found, reached).alias("value"))

    each = rows.groupBy(*by).agg(F.array(*[answer(q) for q in qs]).alias("__answers"))
    return each.select(*by, F.inline("__answers")).select(*by, "value", "q")


def quantile(
    buckets: DataFrame, q: float, by: Sequence[str] = ("step", "eval_ts"),
    le: str = "le", value: str = "value",
) -> DataFrame:
    """One quantile; see :func:`quantiles`."""
    return quantiles(buckets, [q], by, le, value).drop("q")
