"""Text scalars: identifiers, labels, alert fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted severities, and the label/annotation precedence.
SEVERITIES = ("CRITICAL", "WARNING", "INFO")
MESSAGE_KEYS = ("summary", "description", "message")
SOURCE_KEYS = ("instance", "job", "service")


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def non_blank(text: Column) -> Column:
    stripped = strip(text)
    return F.when(stripped != "", stripped)


def quoted(text: Column) -> Column:
    """A string value as validators print it: single quotes unless it holds one."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return (
        F.when(~F.contains(text, F.lit("'")), F.concat(F.lit("'"), escaped, F.lit("'")))
        .when(~F.contains(text, F.lit('"')), F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated UUID, or NULL when the text is not one.

    Accepts braces, a ``urn:uuid:`` prefix, any case and missing hyphens.
    """
    bare = F.regexp_replace(text, "urn:|uuid:", "")
    bare = F.regexp_replace(bare, r"^[{}]+|[{}]+$", "")
    digits = F.lower(F.replace(bare, F.lit("-")))
    plain = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    hyphenated = F.concat_ws(
        "-", *[F.substring(digits, start, size)
               for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    )
    return F.when(text.rlike(plain), text).when(digits.rlike("^[0-9a-f]{32}$"), hyphenated)


def alert_type(name: Column) -> Column:
    """CamelCase to UPPER_SNAKE; runs of capitals stay together."""
    words = F.regexp_replace(name, r"([^\n])([A-Z][a-z]+)", "$1_$2")
    words = F.regexp_replace(words, r"([a-z0-9])([A-Z])", "$1_$2")
    snake = F.upper(F.regexp_replace(words, "_+", "_"))
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit("UNKNOWN")).otherwise(snake)


def severity(raw: Column) -> Column:
    candidate = F.upper(strip(raw))
    return F.when(candidate.isin(*SEVERITIES), candidate).otherwise(F.lit("INFO"))


def alert_status(raw: Column) -> Column:
    return F.when(F.lower(raw) == "resolved", F.lit("RESOLVED")).otherwise(F.lit("FIRING"))


def alert_message(annotations: Column, labels: Column) -> Column:
    name = F.coalesce(labels["alertname"], F.lit("Alert"))
    return F.coalesce(
        *[non_blank(annotations[key]) for key in MESSAGE_KEYS],
        F.concat(name, F.lit(" fired")),
    )


def alert_source(labels: Column) -> Column:
    return F.coalesce(*[non_blank(labels[key]) for key in SOURCE_KEYS])


def label_fingerprint(labels: Column) -> Column:
    """First 16 hex digits of SHA-256 over the sorted ``key=value`` list."""
    pairs = F.transform(
        F.array_sort(F.map_keys(labels)),
        lambda key: F.concat(key, F.lit("="), F.coalesce(labels[key], F.lit("None"))),
    )
    return F.substring(F.sha2(F.array_join(pairs, ","), 256), 1, 16)
