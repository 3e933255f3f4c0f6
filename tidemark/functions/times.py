"""Event-time scalars: windows, lateness, ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. FAST covers what almost every sensor sends and casts directly;
# GENERAL covers the remaining ISO-8601 calendar forms that carry an offset:
# groups are year, month, day, hour, minute, second, fraction, sign, offset
# hours, offset minutes, offset seconds.
FAST_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-](0\d|1[0-7]):[0-5]\d)$"
GENERAL_ISO = (
    r"^(\d{4})(?:-(?=\d{2}-)|(?=\d{4}\D))(\d{2})-?(\d{2})[^0-9]"
    r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    r"(?:Z|([+-])([01]\d|2[0-3])(?::?([0-5]\d)(?::?([0-5]\d))?)?)$"
)


def shift_seconds(ts: Column, seconds: int | float) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(int(round(seconds * 1_000_000))))


def window_start(ts: Column, width_seconds: int = 86_400) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts``."""
    micros, width = F.unix_micros(ts), F.lit(width_seconds * 1_000_000).cast("bigint")
    return F.timestamp_micros(micros - F.pmod(micros, width))


def window_end(start: Column, width_seconds: int = 86_400) -> Column:
    return shift_seconds(start, width_seconds)


def seconds_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def is_late(event_time: Column, watermark: Column) -> Column:
    """Strictly before the watermark; nothing is late before there is one."""
    return F.coalesce(event_time < watermark, F.lit(False))


def lateness_seconds(event_time: Column, watermark: Column) -> Column:
    """Seconds behind the watermark, never below zero."""
    behind = seconds_between(event_time, watermark)
    return F.coalesce(F.greatest(behind, F.lit(0.0)), F.lit(0.0))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds, in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def parse_iso_with_offset(text: Column) -> Column:
    """ISO-8601 date-time carrying an offset, as an instant; NULL otherwise.

    Offsets up to a day and with seconds are taken, which the engine's own cast
    refuses, so in the general form the offset is subtracted arithmetically.
    """

    def group(index: int) -> Column:
        return F.regexp_extract(text, GENERAL_ISO, index)

    def number(index: int) -> Column:
        return F.coalesce(F.try_to_number(group(index), F.lit("99")).cast("bigint"), F.lit(0))

    def part(index: int) -> Column:
        return F.when(group(index) == "", F.lit("00")).otherwise(group(index))

    local = F.concat(
        group(1), F.lit("-"), group(2), F.lit("-"), group(3), F.lit(" "),
        group(4), F.lit(":"), part(5), F.lit(":"), part(6), F.lit("."),
        F.rpad(group(7), 6, "0"), F.lit("Z"),
    )
    offset = number(9) * 3600 + number(10) * 60 + number(11)
    offset = F.when(group(8) == "-", -offset).otherwise(offset)
    general = F.timestamp_micros(
        F.unix_micros(local.try_cast("timestamp")) - offset * 1_000_000
    )
    return (
        F.when(text.rlike(FAST_ISO), text.try_cast("timestamp"))
        .when(text.rlike(GENERAL_ISO), general)
    )
