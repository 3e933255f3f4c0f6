"""Tick-partitioned tables: every tick overwrites only its own folder.

A replayed tick therefore rewrites the same rows, and readers that ask for
earlier ticks never see a half-written attempt of the current one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import by_date


@dataclass(frozen=True)
class TickTable:
    """A Parquet table with one folder per tick, optionally split by a date column."""

    path: str
    schema: T.StructType
    date_column: str | None = None

    def _full_schema(self) -> T.StructType:
        schema = T.StructType([*self.schema.fields, T.StructField("tick", T.LongType())])
        return schema.add(self.date_column, T.DateType()) if self.date_column else schema

    def write(self, rows: DataFrame, tick: int) -> None:
        target = f"{self.path}/tick={tick}"
        if self.date_column:
            by_date(rows, self.date_column).write.mode("overwrite").partitionBy(
                self.date_column).parquet(target)
        else:
            rows.write.mode("overwrite").parquet(target)

    def read(self, spark: SparkSession) -> DataFrame:
        """All ticks; empty when nothing was written yet."""
        return self._load(spark, self.path)

    def only(self, spark: SparkSession, tick: int) -> DataFrame:
        """The rows of one tick, without listing the others; empty if it never ran."""
        return self._load(spark, f"{self.path}/tick={tick}")

    def _load(self, spark: SparkSession, *paths: str) -> DataFrame:
        return self._found(spark, *paths) or spark.createDataFrame([], self._full_schema())

    def _found(self, spark: SparkSession, *paths: str) -> DataFrame | None:
        """The rows of some folders, or None if one is not there."""
        reader = spark.read.schema(self._full_schema()).option("basePath", self.path)
        try:
            return reader.parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def before(self, spark: SparkSession, tick: int, after: int = -1) -> DataFrame:
        """Rows of ticks after ``after`` and before ``tick``; other folders are not read."""
        rows = self.read(spark).where(F.col("tick") < tick)
        return rows.where(F.col("tick") > after) if after >= 0 else rows

    def every(self, spark: SparkSession, after: int, tick: int) -> DataFrame:
        """Rows of all ticks after ``after`` and before ``tick``.

        Their folders are named, so the driver lists none of the others; it does where a tick
        was left out.
        """
        if after + 1 >= tick:
            return spark.createDataFrame([], self._full_schema())
        found = self._found(spark, *[f"{self.path}/tick={t}" for t in range(after + 1, tick)])
        return self.before(spark, tick, after) if found is None else found


#: Ids a bucket of the id table holds when its epoch ends.
BUCKET_IDS = 5_000_000


@dataclass(frozen=True)
class IdTable:
    """The ids stored so far, one partition per tick, in files by hash of the id.

    A look-up joins on the id: the stored side is read as it lies, bucket by
    bucket, so only the batch is shuffled, however long the history is. Buckets follow
    the history: an epoch ends when its buckets are full, and the next one has
    ``GROWTH`` times as many. So a look-up has as many tasks as the history needs, and
    shuffles the batch once per epoch, of which there are logarithmically many.
    """

    path: str
    buckets: int = 16
    bucket_ids: int = BUCKET_IDS

    GROWTH = 4

    def epoch(self, stored: int) -> int:
        """The epoch that takes the next ids when so many are stored."""
        epoch, full = 0, self.buckets * self.bucket_ids
        while stored >= full:
            epoch += 1
            full += self.buckets * self.GROWTH**epoch * self.bucket_ids
        return epoch

    def _table(self, spark: SparkSession, epoch: int) -> str:
        """The catalog's name for an epoch's folder; a new session finds what is there."""
        folder = f"{self.path}/epoch={epoch}"
        name = f"tidemark_ids_{hashlib.md5(folder.encode()).hexdigest()}"
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (event_id STRING, tick BIGINT) USING parquet "
                f"PARTITIONED BY (tick) CLUSTERED BY (event_id) INTO {self.buckets * self.GROWTH**epoch} BUCKETS "
                f"LOCATION '{folder}'"
            )
            # A partition without rows makes sure that the folder exists.
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (tick = -1) "
                      "SELECT '' AS event_id WHERE false")
            spark.catalog.recoverPartitions(name)
        return name

    def found(self, ids: DataFrame, tick: int, stored: int = 0) -> DataFrame:
        """Those of some ids that earlier ticks stored.

        They are dealt to each epoch's own buckets: left to itself, the engine deals the history
        anew where it has fewer buckets than shuffles have partitions.
        """
        spark, ids = ids.sparkSession, ids.select("event_id").distinct()
        hits = [
            part.join(ids.repartition(self.buckets * self.GROWTH**epoch, "event_id"), "event_id", "left_semi")
            for epoch, part in enumerate(self.before(spark, tick, stored))
        ]
        return reduce(DataFrame.unionByName, hits).distinct()

    def write(self, rows: DataFrame, tick: int, stored: int = 0) -> None:
        """Replace the ids of a tick, before which ``stored`` were there: one file per bucket."""
        spark, epoch = rows.sparkSession, self.epoch(stored)
        ids = rows.select("event_id").repartition(self.buckets * self.GROWTH**epoch, "event_id")
        spark.sql(
            f"INSERT OVERWRITE TABLE {self._table(spark, epoch)} PARTITION (tick = {int(tick)}) "
            "SELECT event_id FROM {ids}", ids=ids,
        )

    def before(self, spark: SparkSession, tick: int, stored: int = 0) -> list[DataFrame]:
        """The ids of earlier ticks, a frame per epoch."""
        return [
            spark.table(self._table(spark, epoch)).where(F.col("tick") < tick).select("event_id")
            for epoch in range(self.epoch(stored) + 1)
        ]
