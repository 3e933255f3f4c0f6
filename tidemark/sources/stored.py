"""Stored tables that skip data: folders by date, files by key, defaults for columns added later.

Rows are dealt by ranges of (date, key) and sorted, so a file holds a narrow range of keys
of one date: a time range prunes folders, a key prunes files and row groups by their
statistics, and a Bloom filter per row group answers for keys inside a range. A date or key that
holds most rows is cut into several ranges.

A column added after files were written carries its default in the schema's metadata.
The reader itself gives it for files without the column, so no reader needs to know it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the engine's readers look up for a column that a file lacks.
_EXISTS = "EXISTS_DEFAULT"


@dataclass(frozen=True)
class StoredTable:
    """Parquet files below ``path``, one folder per UTC date of ``time_column``."""

    path: str
    schema: T.StructType
    time_column: str
    date_column: str
    key: tuple[str, ...]

    def with_column(self, name: str, kind: T.DataType, default: str) -> StoredTable:
        """The table with a column more; ``default`` (SQL literal) holds for rows written before."""
        if name in self.schema.names:
            return self
        field = T.StructField(name, kind, True, {_EXISTS: default, "CURRENT_DEFAULT": default})
        return replace(self, schema=T.StructType([*self.schema.fields, field]))

    def write(self, rows: DataFrame, mode: str = "append") -> None:
        order = [self.date_column, *self.key, self.time_column]
        dated = rows.select(*self.schema.names, F.to_date(self.time_column).alias(self.date_column))
        writer = dated.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode)
        for name in self.key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.partitionBy(self.date_column).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField(self.date_column, T.DateType())])
        return spark.read.schema(whole).parquet(self.path)

    def between(self, spark: SparkSession, start: Column, end: Column) -> DataFrame:
        """Rows with ``start <= time < end``; folders of other dates are not read."""
        time, date = F.col(self.time_column), F.col(self.date_column)
        return self.read(spark).where(
            (time >= start) & (time < end) & (date >= F.to_date(start)) & (date <= F.to_date(end)))

    def lookup(self, spark: SparkSession, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Stored rows of just the keys in play.

        ``keys`` also give the date, so only folders in play are read: the join prunes them.
        """
        # The comparison is always true; it marks the side as worth pruning by.
        wanted = keys.select(*columns, F.to_date(self.time_column).alias(self.date_column)).distinct().where(
            F.col(self.date_column) >= F.lit("0001-01-01").cast("date"))
        return self.read(spark).join(wanted, [*columns, self.date_column], "left_semi")
