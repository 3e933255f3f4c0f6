"""Alert rules evaluated tick by tick over a stream of metric samples.

A tick evaluates the steps its samples complete, and no others. It reads its own samples
and three small tables of the tick before: the samples that the next steps can still see
(at most one range per series), the runs that were active at the last step, and the
last step itself. A run that goes on keeps its start, so hold times span ticks. What a
tick finds about runs goes to its own folder; runs merge by least and greatest step.

Samples must come in time order up to ``delay`` seconds: a step is complete once a sample
more than that later has come. ``flush`` evaluates what is left when the stream ends.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.operators import alerts as A
from tidemark.operators import metrics as M
from tidemark.plans import telemetry
from tidemark.streaming.tables import TickTable

_RUN = T.StructType([
    *[T.StructField(name, T.StringType()) for name in A.RUN[:-1]],
    *[T.StructField(name, T.LongType()) for name in ("since", "fired", "last")],
])
_STEPS = T.StructType([T.StructField(name, T.LongType()) for name in ("first", "evaluated", "newest")])


def sample_message(samples: DataFrame) -> DataFrame:
    """Samples as messages of a topic, keyed by instance."""
    return samples.select(
        F.coalesce(F.col("labels")["instance"], F.lit("")).alias("key"),
        F.to_json(F.struct("name", "labels", "value")).cast("binary").alias("value"), F.col("ts").alias("timestamp"),
    )


def samples_of(messages: DataFrame) -> DataFrame:
    found = F.from_json(F.col("value").cast("string"), "name string, labels map<string,string>, value double")
    return messages.select(F.col("timestamp").alias("ts"), found.alias("s")).select(
        "ts", "s.name", "s.labels", "s.value")


@dataclass(frozen=True)
class RuleStream:
    """Where the tables of the rules live, and how they are evaluated."""

    root: str
    rules: Sequence[A.Rule] = A.RULES
    grid: M.Grid = field(default_factory=M.Grid)
    over: int = 300
    lookback: int = 300
    delay: int = 0
    limits: Mapping[str, float] = field(default_factory=dict)

    @property
    def tail(self) -> TickTable:
        """Samples that steps after the tick can still see."""
        return TickTable(f"{self.root}/tail", schemas.METRIC_SAMPLE)

    @property
    def runs(self) -> TickTable:
        return TickTable(f"{self.root}/runs", _RUN)

    @property
    def steps(self) -> TickTable:
        return TickTable(f"{self.root}/steps", _STEPS)

    def intervals(self, spark: SparkSession) -> DataFrame:
        """All runs so far: when they became active, fired and ended."""
        merged = self.runs.read(spark).groupBy(*A.RUN).agg(F.min("fired").alias("fired"), F.max("last").alias("last"))
        return A.run_times(merged, self.grid)

    def _before(self, spark: SparkSession, tick: int) -> dict:
        row = self.steps.only(spark, tick - 1).first()
        return row.asDict() if row else {}

    def process(self, samples: DataFrame, tick: int, last: bool = False) -> None:
        """Evaluate the steps that these samples complete; safe to repeat."""
        spark = samples.sparkSession
        before = self._before(spark, tick)
        seen = samples.select(*schemas.METRIC_SAMPLE.names).unionByName(
            self.tail.only(spark, tick - 1).select(*schemas.METRIC_SAMPLE.names))
        step = self.grid.first_step(F.col("ts"))
        found = samples.agg(F.min(step).alias("lo"), F.max(step).alias("hi"), F.max(F.unix_micros("ts")).alias("t")).first()
        newest = max((v for v in (found.hi, before.get("newest")) if v is not None), default=None)
        if newest is None:
            return
        first = before.get("first", found.lo)
        done = before.get("evaluated", first - 1)
        # Another sample of the newest moment may follow, so its own step is open yet.
        complete = done if found.t is None else (found.t - 1 - self.delay * 1_000_000) // self.grid.micros
        # At the end, steps after the last sample still see it for a while.
        upto = newest + self.grid.steps_in(max(self.over, self.lookback)) if last else max(done, min(complete, newest))
        self._evaluate(spark, seen, tick, done, upto, newest)
        reach = max(self.over, self.lookback)
        self.tail.write(seen.where(F.unix_micros("ts") > (upto + 1) * self.grid.micros - reach * 1_000_000), tick)
        self.steps.write(spark.range(1, numPartitions=1).select(
            F.lit(first).cast("bigint").alias("first"), F.lit(upto).cast("bigint").alias("evaluated"),
            F.lit(newest).cast("bigint").alias("newest")), tick)

    def _evaluate(
        self, spark: SparkSession, seen: DataFrame, tick: int, done: int, upto: int, newest: int
    ) -> None:
        missing = spark.range(1, numPartitions=1).select(
            F.lit(done + 1).cast("bigint").alias("lo"), F.lit(min(upto, newest)).cast("bigint").alias("hi")
        ).where("lo <= hi")
        conditions = telemetry.alert_conditions(
            seen, over=self.over, lookback=self.lookback, grid=self.grid, bounds=missing, **self.limits)
        active = [c.where(F.col("step").between(done + 1, upto)) for c in conditions]
        carried = self.runs.only(spark, tick - 1).where(F.col("last") == done)
        found = A.runs(A.evaluate(active, self.rules, self.grid, carried, done + 1))
        if upto == done:
            # No step was completed: what was active stays so.
            found = found.unionByName(carried.select(*_RUN.names))
        self.runs.write(found.select(*_RUN.names), tick)

    def flush(self, spark: SparkSession) -> None:
        """Evaluate the steps that wait for more samples, as a tick after the last one."""
        tick = self.steps.read(spark).agg(F.max("tick")).first()[0]
        if tick is not None:
            self.process(spark.createDataFrame([], schemas.METRIC_SAMPLE), tick + 1, last=True)

    def start(self, samples: DataFrame, checkpoint: str, *, seconds: int = 15) -> DataStreamWriter:
        return samples.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds")
