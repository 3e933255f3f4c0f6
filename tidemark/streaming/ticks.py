"""The event path as a micro-batch: one tick validates, stores, folds, finalizes.

The engine's watermark drops late rows before anything can store them, so the
watermark is kept here, in a ledger with one row per tick. Everything a tick
writes goes to its own folder; the ledger row comes last. Only that row's few
numbers ever reach the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark import names, schemas
from tidemark.functions import times
from tidemark.operators import contract as contracts
from tidemark.operators import daily, dedupe, enrich, eventtime
from tidemark.operators.metrics import INFINITY, LATENCY_BOUNDS
from tidemark.operators.running import topic_blocks
from tidemark.policy import FLUSH_INTERVAL_SECONDS, EventTimePolicy
from tidemark.sources.tables import latest
from tidemark.streaming.tables import BUCKET_IDS, IdTable, TickTable

#: Outputs of a tick that are written at the same time.
WRITERS = 4
ORDER = ("src_slice", "src_topic", "src_partition", "src_offset")

# Running totals kept in the ledger, by metric name and label.
TOTALS = (
    "processed", "abnormal", "duplicates", "late_aggregated", "late_finalized", "late_duplicate",
    "failed_decode", "failed_validation", "dead_lettered", "windows_opened", "windows_finalized",
    *[f"seconds_le_{index}" for index in range(len(LATENCY_BOUNDS) + 1)],
)


def _ledger_schema() -> T.StructType:
    fields = [T.StructField("max_event_time", T.TimestampType())]
    return T.StructType(fields + [T.StructField(name, T.LongType()) for name in TOTALS])


@dataclass(frozen=True)
class EventStream:
    """Where the tables of one stream live, and its policy.

    ``id_buckets`` is the number of files the stored ids of a tick are kept in at
    first; it grows with the history. Every ``compact_every`` ticks the newest states become
    a new base, so a tick reads, and lists, no more than so many folders of the log.
    """

    root: str
    policy: EventTimePolicy = field(default_factory=EventTimePolicy)
    contract: contracts.Contract = contracts.READING
    id_buckets: int = 16
    bucket_ids: int = BUCKET_IDS
    compact_every: int = 100

    @property
    def raw(self) -> TickTable:
        return TickTable(f"{self.root}/raw", schemas.RAW, "event_date")

    @property
    def ids(self) -> IdTable:
        return IdTable(f"{self.root}/ids", self.id_buckets, self.bucket_ids)

    @property
    def clock(self) -> TickTable:
        """When each tick began first: a replay uses the same time."""
        return TickTable(f"{self.root}/clock", T.StructType([T.StructField("began", T.TimestampType())]))

    @property
    def states(self) -> TickTable:
        return TickTable(f"{self.root}/daily_log", schemas.DAILY, "window_date")

    @property
    def dead_letters(self) -> TickTable:
        return TickTable(f"{self.root}/dead_letters", schemas.DEAD_LETTER)

    @property
    def ledger(self) -> TickTable:
        return TickTable(f"{self.root}/ledger", _ledger_schema())

    @property
    def samples(self) -> TickTable:
        return TickTable(f"{self.root}/metric_samples", schemas.METRIC_SAMPLE)

    @property
    def bases(self) -> TickTable:
        """Compacted states: folder tick=N holds the newest state per key up to N."""
        return TickTable(f"{self.root}/daily_base", schemas.DAILY, "window_date")

    @property
    def base_index(self) -> TickTable:
        return TickTable(f"{self.root}/daily_base_index", T.StructType(
            [T.StructField("windows", T.LongType())]))

    # -- Views ---------------------------------------------------------------

    def daily(self, spark: SparkSession) -> DataFrame:
        """The daily table: newest state of every window."""
        return self._states_before(spark, None).drop("tick", "window_date")

    def _states_before(
        self, spark: SparkSession, tick: int | None,
        restrict: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        limit = 2**62 if tick is None else tick
        base = self.base_index.before(spark, limit).agg(F.max("tick")).first()[0]
        if base is None:
            log = self.states.before(spark, limit)
        else:
            # The first tick after the base is the least that matters: no older folder is listed.
            recent = self.states.before(spark, limit, base) if tick is None else self.states.every(spark, base, tick)
            log = recent.unionByName(self.bases.only(spark, base))
        if restrict is not None:
            log = restrict(log)
        return latest(log, daily.KEY)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Write the newest state per window up to a tick as the new base.

        Readers switch over when the index row appears; older log folders are no
        longer read and may be removed by whoever owns retention.
        """
        states = self._states_before(spark, upto + 1).drop("tick")
        self.bases.write(states, upto)
        written = self.bases.read(spark).where(F.col("tick") == upto)
        self.base_index.write(written.agg(F.count(F.lit(1)).alias("windows")), upto)

    # -- One tick --------------------------------------------------------------

    def process(self, batch: DataFrame, tick: int) -> None:
        """Handle one micro-batch of topic messages; safe to repeat.

        Outputs that do not depend on each other are written at the same time; the ledger row
        comes after all of them.
        """
        spark = batch.sparkSession
        began = self._began(spark, tick)
        now = F.timestamp_micros(F.lit(began))
        previous = self._previous(spark, tick)
        before = previous.get("max_event_time")
        stored = (previous.get("processed") or 0) - (previous.get("duplicates") or 0)
        validated = self._settle(
            contracts.validate(contracts.decode(batch), self.contract)
            .drop("key", "value", "doc", "doc_keys", "errors"),
            "validated",
        )
        valid, invalid = contracts.split(validated)
        with ThreadPoolExecutor(WRITERS) as pool:
            def aside(work: Callable, *args) -> Future:
                return pool.submit(inheritable_thread_target(spark)(work), *args)

            beside = [aside(self.dead_letters.write, enrich.dead_letters(invalid, now), tick)]
            messages = aside(self._message_totals, validated, now)
            tagged = self._settle(
                self._tag(spark, contracts.to_readings(valid, self.contract), tick, before, now, stored),
                "tagged",
            )
            fresh = tagged.where("is_new").select(*schemas.RAW.names)
            beside += [
                aside(self.raw.write, fresh.withColumn("event_date", F.to_date("event_time")), tick),
                aside(self.ids.write, fresh, tick, stored),
            ]
            rows = self._row_totals(tagged)
            seen = [t for t in (before, rows.pop("newest")) if t is not None]
            newest = max(seen) if seen else None
            changes = self._settle(
                self._changes(spark, tagged, tick, before, newest, now), "changes"
            )
            beside.append(aside(self._write_states, changes, tick))
            totals = {**self._window_totals(changes), **rows, **messages.result()}
            for written in beside:
                written.result()
        self._write_ledger(spark, tick, began, newest, {
            name: (previous.get(name) or 0) + (totals[name] or 0) for name in TOTALS
        })
        if self.compact_every and tick and tick % self.compact_every == 0:
            self.compact(spark, tick)

    def _settle(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate result of the tick next to its tables and read it back.

        Several outputs depend on it: they prune its columns, keep short plans,
        and a lost executor costs a re-read. Each tick overwrites the last one's.
        """
        path = f"{self.root}/work/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _began(self, spark: SparkSession, tick: int) -> int:
        """The tick's time in microseconds, written before anything else of it."""
        began = self.clock.only(spark, tick).agg(F.max(F.unix_micros("began"))).first()[0]
        if began is None:
            began = int(dt.datetime.now(dt.UTC).timestamp() * 1e6)
            one = spark.range(1, numPartitions=1)
            self.clock.write(one.select(F.timestamp_micros(F.lit(began)).alias("began")), tick)
        return began

    def _previous(self, spark: SparkSession, tick: int) -> dict:
        """The ledger row of the latest earlier tick: one row of numbers.

        Instants reach the driver as microseconds, never as local datetimes.
        """
        def numbers(rows: DataFrame) -> DataFrame:
            return rows.withColumn("max_event_time", F.unix_micros("max_event_time"))

        row = numbers(self.ledger.only(spark, tick - 1)).first()
        if row is None and tick > 0:
            row = numbers(self.ledger.before(spark, tick)).orderBy(F.desc("tick")).first()
        return row.asDict() if row else {}

    def _tag(
        self, spark: SparkSession, rows: DataFrame, tick: int, carry: int | None,
        now: Column, stored: int,
    ) -> DataFrame:
        levels = topic_blocks(F.col("src_slice"), F.col("src_offset"), F.col("src_topic"),
                              F.col("src_partition"))
        observed = eventtime.observe(
            rows, order=ORDER, levels=levels, policy=self.policy,
            carry=None if carry is None else F.timestamp_micros(F.lit(carry)),
        )
        flagged = dedupe.insert_if_absent(observed, lambda ids: self.ids.found(ids, tick, stored), order=ORDER)
        return enrich.with_status(flagged).withColumn("ingestion_time", now)

    def _changes(
        self, spark: SparkSession, tagged: DataFrame, tick: int,
        before: int | None, newest: int | None, now: Column,
    ) -> DataFrame:
        """Every window this tick touches or closes, with old and new state."""
        new_rows = daily.assign_window(tagged.where("is_new"), self.policy)
        partials = daily.fold(new_rows, late=True)
        stored = self._states_before(spark, tick, self._relevant(partials, before))
        old = stored.select(
            *daily.KEY, *[F.col(m).alias(f"old_{m}") for m in daily.MEASURES],
            F.col("is_finalized").alias("was_finalized"),
        )
        both = partials.join(old, list(daily.KEY), "full")
        closed_before = F.coalesce("was_finalized", F.lit(False))
        touched = F.col("event_count").isNotNull()
        merged = {
            "event_count": _add("event_count"),
            "heart_rate_sum": _add("heart_rate_sum"),
            "minimum_heart_rate": F.least("minimum_heart_rate", "old_minimum_heart_rate"),
            "maximum_heart_rate": F.greatest("maximum_heart_rate", "old_maximum_heart_rate"),
            "abnormal_count": _add("abnormal_count"),
        }
        watermark = times.shift_seconds(
            F.timestamp_micros(F.lit(newest).cast("bigint")), -self.policy.out_of_orderness)
        window_end = times.window_end(F.col("window_start"), self.policy.window)
        closes = F.coalesce(
            watermark > times.shift_seconds(window_end, self.policy.allowed_lateness),
            F.lit(False),
        )
        # A finalized window never changes again: its late rows are refused.
        return both.withColumns({
            "refused": closed_before & touched,
            "accepted": ~closed_before & touched,
            "opened": touched & F.col("was_finalized").isNull(),
            "window_end": window_end,
            "finalizes": ~closed_before & closes,
            **{f"new_{m}": merged[m] for m in daily.MEASURES},
        }).withColumn("finalized_at", F.when(F.col("finalizes"), now)).where(
            F.col("refused") | F.col("accepted") | F.col("finalizes")
        )

    def _relevant(
        self, partials: DataFrame, before: int | None
    ) -> Callable[[DataFrame], DataFrame]:
        """Keep the window dates of the state table that can matter to this tick.

        Windows still open after the last tick end no earlier than its watermark
        less the lateness; any other window matters only if the tick touches it,
        which a join on the partition column prunes to.
        """
        # The comparison is always true; it marks the side as worth pruning by.
        touched = partials.select(F.to_date("window_start").alias("window_date")).where(
            F.col("window_date") >= F.lit("0001-01-01").cast("date")).distinct()
        if before is None:
            return lambda log: log.join(touched, "window_date", "left_semi")
        reach = (self.policy.out_of_orderness + self.policy.allowed_lateness
                 + self.policy.window)
        oldest_open = F.to_date(F.timestamp_micros(F.lit(before - reach * 1_000_000)))

        def restrict(log: DataFrame) -> DataFrame:
            closed = log.where(F.col("window_date") < oldest_open)
            return log.where(F.col("window_date") >= oldest_open).unionByName(
                closed.join(touched, "window_date", "left_semi"))

        return restrict

    def _write_states(self, changes: DataFrame, tick: int) -> None:
        kept = changes.where(F.col("accepted") | F.col("finalizes")).select(
            *daily.KEY, "window_end", *[F.col(f"new_{m}").alias(m) for m in daily.MEASURES],
            "finalized_at", F.col("finalizes").alias("is_finalized"),
        ).withColumn("average_heart_rate", daily.average())
        kept = kept.select(*schemas.DAILY.names, F.to_date("window_start").alias("window_date"))
        self.states.write(kept, tick)

    def _message_totals(self, validated: DataFrame, now: Column) -> dict[str, int]:
        waited = times.seconds_between(F.col("timestamp"), now)
        return validated.agg(
            F.count_if(F.col("error_type") == contracts.DECODE_ERROR).alias("failed_decode"),
            F.count_if(F.col("error_type") == contracts.VALIDATION_ERROR)
            .alias("failed_validation"),
            F.count_if(~F.col("is_valid")).alias("dead_lettered"),
            *[F.count_if(waited <= F.lit(le)).alias(f"seconds_le_{index}")
              for index, le in enumerate([*LATENCY_BOUNDS, INFINITY])],
        ).first().asDict()

    def _row_totals(self, tagged: DataFrame) -> dict:
        return tagged.agg(
            F.max(F.unix_micros("event_time")).alias("newest"),
            F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("is_new") & (F.col("status") == "ABNORMAL")).alias("abnormal"),
            F.count_if(~F.col("is_new")).alias("duplicates"),
            F.count_if(~F.col("is_new") & F.col("is_late")).alias("late_duplicate"),
        ).first().asDict()

    def _window_totals(self, changes: DataFrame) -> dict[str, int]:
        return changes.agg(
            F.sum(F.when(F.col("accepted"), F.col("late_rows"))).alias("late_aggregated"),
            F.sum(F.when(F.col("refused"), F.col("late_rows"))).alias("late_finalized"),
            F.count_if("opened").alias("windows_opened"),
            F.count_if("finalizes").alias("windows_finalized"),
        ).first().asDict()

    def _write_ledger(
        self, spark: SparkSession, tick: int, began: int, newest: int | None,
        totals: dict[str, int],
    ) -> None:
        one = spark.range(1, numPartitions=1)
        samples = [
            F.struct(
                F.timestamp_micros(F.lit(began)).alias("ts"), F.lit(name).alias("name"),
                F.create_map(*[F.lit(part) for pair in labels.items() for part in pair])
                .alias("labels"),
                F.lit(float(value)).alias("value"),
            )
            for name, labels, value in _sample_values(totals, newest, began, self.policy)
        ]
        self.samples.write(one.select(F.inline(F.array(*samples))), tick)
        self.ledger.write(one.select(
            F.timestamp_micros(F.lit(newest).cast("bigint")).alias("max_event_time"),
            *[F.lit(totals[name]).cast("bigint").alias(name) for name in TOTALS],
        ), tick)

    def flush(self, spark: SparkSession) -> None:
        """What a shutdown forces: a tick without messages, after the last one.

        It finalizes windows that the watermark has passed and writes the totals again; the
        open ones are in the table since the tick that touched them.
        """
        last = self.ledger.read(spark).agg(F.max("tick")).first()[0]
        if last is not None:
            self.process(spark.createDataFrame([], schemas.TOPIC), last + 1)

    # -- Running -----------------------------------------------------------------

    def start(
        self, messages: DataFrame, checkpoint: str, *,
        seconds: int | None = FLUSH_INTERVAL_SECONDS,
    ) -> DataStreamWriter:
        """A writer ready to ``start()``: a tick every ``seconds``, or all at once if None.

        The checkpoint advances only after a tick has written everything.
        """
        writer = messages.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", checkpoint)
        if seconds is None:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=f"{seconds} seconds")


def _add(measure: str) -> Column:
    return F.coalesce(F.col(measure), F.lit(0)) + F.coalesce(F.col(f"old_{measure}"), F.lit(0))


def _sample_values(
    totals: dict[str, int], newest: int | None, now: int, policy: EventTimePolicy
) -> Sequence[tuple[str, dict[str, str], float]]:
    job = {"job": "consumer", "instance": "stream"}
    values = [
        (names.PROCESSED, job, totals["processed"]),
        (names.FAILED, {**job, "reason": "validation"},
         totals["failed_validation"]),
        (names.FAILED, {**job, "reason": "decode"}, totals["failed_decode"]),
        (names.DEAD_LETTERED, job, totals["dead_lettered"]),
        (names.ABNORMAL, job, totals["abnormal"]),
        (names.LATE, {**job, "aggregated": "true"}, totals["late_aggregated"]),
        (names.LATE, {**job, "aggregated": "false"},
         totals["late_finalized"] + totals["late_duplicate"]),
        (names.DUPLICATES, job, totals["duplicates"]),
        (names.WINDOWS_FINALIZED, job, totals["windows_finalized"]),
        (names.WINDOWS_OPEN, job, totals["windows_opened"] - totals["windows_finalized"]),
        (names.UP, job, 1),
    ]
    for index, bound in enumerate([*LATENCY_BOUNDS, INFINITY]):
        le = "+Inf" if bound == INFINITY else repr(bound)
        values.append((names.LATENCY_BUCKET, {**job, "le": le},
                       totals[f"seconds_le_{index}"]))
    if newest is not None:
        lag = (now - newest) / 1e6 + policy.out_of_orderness
        values.append((names.WATERMARK_LAG, job, lag))
    return values
