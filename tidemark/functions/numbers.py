"""Numeric scalars of the reports and metric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round like SQL ``numeric``: half away from zero, on the decimal value."""
    return F.round(value.cast("decimal(24,9)"), digits)


def clamp_min(value: Column, floor: float) -> Column:
    return F.greatest(value, F.lit(float(floor)))
