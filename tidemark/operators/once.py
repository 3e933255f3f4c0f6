"""Derived columns that are evaluated once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later steps must not recompute.

    Projections are merged and filters pushed down by repeating the derivation of
    the columns they use; for a parse or a list of rules that multiplies the
    work. Columns that come out of ``inline`` are computed once.
    """
    made = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    return df.select("*", F.inline(made))
