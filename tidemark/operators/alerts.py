"""Alert rules: hold times, inhibition, grouping, repeat suppression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.metrics import Grid
from tidemark.operators.running import BLOCK_ROWS, running


@dataclass(frozen=True)
class Rule:
    """What an alert is called and how long its condition must hold."""

    name: str
    severity: str
    component: str
    hold: int


# Names, severities, components, hold times and thresholds.
CONSUMER_DOWN = Rule("ConsumerDown", "CRITICAL", "consumer", 60)
SINK_UNAVAILABLE = Rule("PostgresUnavailable", "CRITICAL", "postgres", 60)
LAG_HIGH = Rule("KafkaLagHigh", "WARNING", "consumer", 300)
LATENCY_HIGH = Rule("ProcessingLatencyHigh", "WARNING", "consumer", 300)
DEAD_LETTERS_HIGH = Rule("DLQRateHigh", "WARNING", "consumer", 300)
WATERMARK_STUCK = Rule("WatermarkStuck", "WARNING", "consumer", 600)
RULES = (
    CONSUMER_DOWN, SINK_UNAVAILABLE, LAG_HIGH, LATENCY_HIGH, DEAD_LETTERS_HIGH, WATERMARK_STUCK,
)
LAG_LIMIT = 10_000
LATENCY_LIMIT = 0.5
DEAD_LETTER_LIMIT = 0.05
WATERMARK_LAG_LIMIT = 900
GROUP_INTERVAL = 60
RESOLVE_TIMEOUT = 120


@dataclass(frozen=True)
class Routing:
    """When a group is announced for the first time, updated and repeated."""

    wait: int
    interval: int
    repeat: int


# Routing by severity, in seconds.
ROUTES = {
    "CRITICAL": Routing(wait=5, interval=GROUP_INTERVAL, repeat=1800),
    "default": Routing(wait=10, interval=GROUP_INTERVAL, repeat=3600),
}


def held_since(active: DataFrame, series: Sequence[str], grid: Grid) -> DataFrame:
    """Add ``since``: the step at which the current unbroken run of steps began.

    ``active`` has one row per series and step at which a condition is true.
    Runs may be arbitrarily long, so neither the look at the preceding step nor
    the carrying forward of the start sorts a whole series in one task.
    """
    columns = active.columns
    step = F.col("step")
    copies = active.withColumn(
        "__chunk", F.explode(F.sequence(grid.chunk_of(step), grid.chunk_of(step + 1)))
    )
    before = F.lag("step").over(Window.partitionBy(*series, "__chunk").orderBy("step"))
    starts = (
        copies.withColumn("__before", before)
        .where(F.col("__chunk") == grid.chunk_of(step))
        .withColumn(
            "__start",
            F.when(F.col("__before").isNull() | (F.col("__before") != step - 1), step),
        )
    )
    chunk = F.col("__chunk")
    levels = [[F.call_function("div", chunk, F.lit(BLOCK_ROWS).cast("bigint"))], [chunk]]
    return running(
        starts, F.col("__start"), "since", order=["step"], levels=levels,
        partition_by=series, inclusive=True,
    ).select(*columns, "since")


def condition(rule: Rule, holding: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Steps at which a rule's condition holds, labelled with the rule.

    ``series`` labels become the ``instance`` text; rules over aggregates have
    none.
    """
    names = [F.col(name) for name in series]
    instance = F.concat_ws(",", *names) if names else F.lit("")
    return holding.select(
        F.lit(rule.name).alias("alertname"), instance.alias("instance"), "step", "value"
    )


def evaluate(
    conditions: Sequence[DataFrame], rules: Sequence[Rule], grid: Grid,
    carried: DataFrame | None = None, first_step: int | None = None,
) -> DataFrame:
    """Alert instances of all rules at every step their condition is true.

    State is ``pending`` until the condition has held for the rule's time. All
    rules are followed in one pass, as series of one frame. ``carried`` (alertname,
    instance, since) are runs that were active just before ``first_step``: a run that begins
    there goes on with theirs.
    """
    held = held_since(union_all(conditions), ["alertname", "instance"], grid)
    if carried is not None:
        before = carried.select("alertname", "instance", F.col("since").alias("__since"))
        held = held.join(before, ["alertname", "instance"], "left").withColumn(
            "since", F.when(F.col("since") == first_step, F.coalesce("__since", "since")).otherwise(F.col("since"))
        ).drop("__since")

    def of_rule(attribute: str) -> Column:
        pairs = [F.lit(v) for r in rules for v in (r.name, getattr(r, attribute))]
        return F.create_map(*pairs)[F.col("alertname")]

    lasting = (F.col("step") - F.col("since")) * grid.step
    return held.select(
        "alertname",
        of_rule("severity").alias("severity"),
        of_rule("component").alias("component"),
        "instance", "step", "since", "value",
        F.when(lasting >= of_rule("hold"), F.lit("firing")).otherwise(F.lit("pending"))
        .alias("state"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def firing(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("state") == "firing")


RUN = ("alertname", "severity", "component", "instance", "since")


def runs(alerts: DataFrame) -> DataFrame:
    """One row per run, in steps: ``since``, ``fired`` (if it did) and the ``last`` one seen.

    Runs of consecutive stretches of steps merge by the least ``fired`` and the greatest ``last``.
    """
    return alerts.groupBy(*RUN).agg(
        F.min(F.when(F.col("state") == "firing", F.col("step"))).alias("fired"),
        F.max("step").alias("last"),
    )


def run_times(found: DataFrame, grid: Grid) -> DataFrame:
    """When runs became active, fired and ended."""
    return found.select(
        *RUN[:-1],
        grid.time(F.col("since")).alias("active_at"),
        grid.time(F.col("fired")).alias("fired_at"),
        grid.time(F.col("last") + 1).alias("ended_at"),
    )


def intervals(alerts: DataFrame, grid: Grid) -> DataFrame:
    """One row per run: when it became active, fired (if it did) and ended."""
    return run_times(runs(alerts), grid)


def messages(runs: DataFrame, until: Column) -> DataFrame:
    """What the runs of :func:`intervals` tell a notification history.

    A run that fired sends FIRING when it did, and RESOLVED when it had ended by
    ``until``; runs that never fired send nothing.
    """
    fired = runs.where(F.col("fired_at").isNotNull()).withColumns({
        "fingerprint": F.concat_ws("|", "alertname", "severity", "component", "instance"),
        "ended_at": F.when(F.col("ended_at") <= until, F.col("ended_at")),
    })
    moments = F.filter(
        F.array(
            F.struct(F.lit("FIRING").alias("status"), F.col("fired_at").alias("received_at")),
            F.struct(F.lit("RESOLVED").alias("status"), F.col("ended_at").alias("received_at")),
        ),
        lambda moment: moment["received_at"].isNotNull(),
    )
    told = fired.select(
        "fingerprint", F.col("alertname").alias("alert_type"), "severity", "instance",
        F.inline(moments),
    )
    return told.select(
        F.unix_micros("received_at").alias("arrival"), F.lit(0).alias("position"), "received_at",
        "fingerprint", "alert_type", "severity", F.lit(None).cast("string").alias("message"),
        F.col("instance").alias("source"), "status", F.col("received_at").alias("created_at"),
        F.create_map(F.lit("alertname"), F.col("alert_type")).alias("labels"),
    )


def rule_states(
    spark: SparkSession, alerts: DataFrame, at_step: Column, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Every rule with its state at one step: inactive, pending or firing."""
    listed = spark.createDataFrame(
        [(r.name, r.severity) for r in rules], "alertname string, severity string"
    )
    # One row per rule: firing outranks pending.
    current = (
        alerts.where(F.col("step") == at_step)
        .groupBy("alertname")
        .agg(F.min("state").alias("__state"))
    )
    return listed.join(current, "alertname", "left").select(
        "alertname", F.coalesce("__state", F.lit("inactive")).alias("state"), "severity"
    )


def inhibit(
    alerts: DataFrame, source: str = CONSUMER_DOWN.name, equal: Sequence[str] = ("component",)
) -> DataFrame:
    """Drop firing alerts explained by ``source`` firing at the same time.

    ``equal`` lists the labels both must share; the source itself stays.
    """
    causes = (
        alerts.where(F.col("alertname") == source)
        .select("step", *equal).distinct().withColumn("__cause", F.lit(True))
    )
    return (
        alerts.join(causes, ["step", *equal], "left")
        .where(F.col("__cause").isNull() | (F.col("alertname") == source))
        .select(*alerts.columns)
    )


def group(alerts: DataFrame, by: Sequence[str] = ("alertname", "component")) -> DataFrame:
    """One row per group and step: one incident is one notification.

    Members are counted and fingerprinted, not collected, so a group may hold
    any number of instances. Hashes are summed, as equal members would cancel
    each other in an exclusive or.
    """
    member = F.pmod(F.xxhash64(*by, "alertname", "instance", "severity"), F.lit(1 << 40))
    return alerts.groupBy(*by, "step").agg(
        F.min("severity").alias("severity"),
        F.count(F.lit(1)).alias("alerts"),
        F.min("since").alias("oldest"),
        F.sum(member).alias("members"),
    )


def schedule(
    groups: DataFrame, grid: Grid, by: Sequence[str] = ("alertname", "component"),
    routes: dict[str, Routing] = ROUTES,
) -> DataFrame:
    """Notifications sent per group: first, changed members, and repeats.

    A group is looked at ``wait`` seconds after it appears and then every
    ``interval``. It is announced when its members differ from the previous look,
    or when ``repeat`` seconds have passed since the last announcement.
    """
    held = held_since(groups, list(by), grid)
    critical, default = routes["CRITICAL"], routes["default"]

    def routed(name: str) -> Column:
        return F.when(F.col("severity") == "CRITICAL", F.lit(getattr(critical, name))).otherwise(
            F.lit(getattr(default, name))
        ).cast("bigint")

    # Look number k happens at since * step + wait + k * interval; a row covers
    # the looks that fall between its step and the next. Members are the same at all
    # of them, so only the first can bring a change; the others only repeat.
    offset = (F.col("step") - F.col("since")) * grid.step - routed("wait")
    covered = held.withColumns({
        "__lo": F.greatest(F.lit(0).cast("bigint"), F.ceil(offset / routed("interval"))),
        "__hi": F.ceil((offset + grid.step) / routed("interval")) - 1,
    }).where(F.col("__hi") >= F.col("__lo"))
    ordered = Window.partitionBy(*by, "since").orderBy("step")
    first, last = F.col("__lo"), F.col("__hi")
    changed = covered.withColumn(
        "__changed",
        F.when(first == 0, F.lit("first")).when(
            F.lag("members").over(ordered) != F.col("members"), F.lit("changed")
        ),
    )
    told = changed.withColumn(
        "__told", F.max(F.when(F.col("__changed").isNotNull(), first)).over(ordered))
    # Announcements, not looks, are made into rows.
    every = F.ceil(routed("repeat") / routed("interval"))
    since_told = F.ceil((first - F.col("__told")) / every) * every
    again = F.when(F.col("__changed").isNotNull(), first + every).otherwise(F.col("__told") + since_told)
    repeats = F.when(again <= last, F.sequence(again, last, every)).otherwise(F.array().cast("array<bigint>"))
    announced = F.concat(
        F.when(F.col("__changed").isNotNull(), F.array(F.struct(first.alias("look"), F.col("__changed").alias("reason"))))
        .otherwise(F.array().cast("array<struct<look: bigint, reason: string>>")),
        F.transform(repeats, lambda look: F.struct(look.alias("look"), F.lit("repeat").alias("reason"))),
    )
    seconds = F.col("since") * grid.step + routed("wait") + F.col("look") * routed("interval")
    return told.select("*", F.inline(announced)).select(
        *by, "severity", "alerts", "reason",
        grid.time(F.col("since")).alias("group_since"),
        F.timestamp_seconds(seconds).alias("notify_at"),
        F.when(F.col("severity") == "CRITICAL", F.lit("critical"))
        .otherwise(F.lit("default")).alias("route"),
    )


def auto_resolve(
    updates: DataFrame, key: str = "fingerprint", timeout: int = RESOLVE_TIMEOUT
) -> DataFrame:
    """Episodes of alerts that carry no end time.

    Updates at most ``timeout`` seconds apart belong together; the episode ends
    ``timeout`` after its last update.
    """
    micros = F.unix_micros("ts")
    # Years, days, and ten minutes: a noisy alert's day is many blocks.
    levels = [[F.call_function("div", micros, F.lit(size * 1_000_000).cast("bigint"))]
              for size in (365 * 86_400, 86_400, 600)]
    rows = updates.select(key, "ts").distinct()
    seen = running(
        rows, micros, "__before", order=["ts"], levels=levels, partition_by=[key]
    )
    gap = F.lit(timeout * 1_000_000).cast("bigint")
    starts = seen.withColumn(
        "__start",
        F.when(F.col("__before").isNull() | (micros - F.col("__before") > gap), micros),
    )
    runs = running(
        starts, F.col("__start"), "__since", order=["ts"], levels=levels,
        partition_by=[key], inclusive=True,
    )
    return runs.groupBy(key, F.timestamp_micros("__since").alias("started_at")).agg(
        F.count(F.lit(1)).alias("updates"),
        F.timestamp_micros(F.max(micros) + gap).alias("resolved_at"),
    )
