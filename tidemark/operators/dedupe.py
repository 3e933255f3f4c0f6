"""First arrival per event id, within a frame and against stored history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_arrivals(
    df: DataFrame, key: str = "event_id", order: Sequence[str] = ("arrival",)
) -> DataFrame:
    """(key, order...) of the first arrival of each id; combines map-side."""
    if len(order) == 1:
        return df.groupBy(key).agg(F.min(order[0]).alias(order[0]))
    first = F.min(F.struct(*order)).alias("__first")
    return df.groupBy(key).agg(first).select(key, "__first.*")


def flag_first_arrivals(
    df: DataFrame, key: str = "event_id", order: Sequence[str] = ("arrival",)
) -> DataFrame:
    """Add ``is_new``: true on the first arrival of each id only.

    The flag is joined back on (id, position), not computed in a window per id,
    so an id redelivered a billion times is spread over all tasks. Positions
    must be unique.
    """
    firsts = first_arrivals(df, key, order).withColumn("__first", F.lit(True))
    return (
        df.join(firsts, [key, *order], "left")
        .withColumn("is_new", F.col("__first").isNotNull())
        .drop("__first")
        .select(*df.columns, "is_new")
    )


def keep_first_arrivals(
    df: DataFrame, key: str = "event_id", order: Sequence[str] = ("arrival",)
) -> DataFrame:
    """Only the first arrival of each id."""
    return df.join(first_arrivals(df, key, order), [key, *order], "left_semi")


def already_stored(batch: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Ids of ``batch`` that exist in ``stored``.

    The batch is the small side: when its ids are under the broadcast limit the
    history is scanned for one column and never shuffled.
    """
    return stored.select(key).join(batch.select(key).distinct(), key, "left_semi").distinct()


def insert_if_absent(
    batch: DataFrame, stored: DataFrame | Callable[[DataFrame], DataFrame], key: str = "event_id",
    order: Sequence[str] = ("arrival",),
) -> DataFrame:
    """Add ``is_new``: first arrival in the batch and not stored before.

    ``stored`` is the history, or a look-up that gives those of some ids that it holds.
    """
    firsts = first_arrivals(batch, key, order)
    known = already_stored(firsts, stored, key) if isinstance(stored, DataFrame) else stored(firsts.select(key))
    fresh = firsts.join(known, key, "left_anti")
    return (
        batch.join(fresh.withColumn("__fresh", F.lit(True)), [key, *order], "left")
        .withColumn("is_new", F.col("__fresh").isNotNull())
        .select(*batch.columns, "is_new")
    )


#: Size of a distinct-count sketch (2**14 registers at most), and three standard errors of its estimate.
SKETCH_BITS = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], key: str = "event_id") -> DataFrame:
    """A mergeable sketch of the distinct ids of each group, and its rows: a few kilobytes a group.

    Kept per tick, any range of ticks is counted later without reading its rows.
    """
    return df.groupBy(*by).agg(
        F.hll_sketch_agg(key, F.lit(SKETCH_BITS)).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and the estimated distinct ids of united sketches."""
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"),
    )


def duplicate_summary(df: DataFrame, key: str = "event_id", approx: bool = False) -> DataFrame:
    """Rows, distinct ids and surplus rows."""
    if approx:
        counts = df.agg(
            F.count(F.lit(1)).alias("stored"),
            F.hll_sketch_estimate(F.hll_sketch_agg(key, F.lit(SKETCH_BITS))).alias("distinct_ids"),
        )
    else:
        # Two plain aggregations instead of count(DISTINCT): the per-id rows
        # combine map-side, so a hot id costs nothing extra.
        counts = (
            df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
            .agg(
                F.coalesce(F.sum("__n"), F.lit(0)).alias("stored"),
                F.count(key).alias("distinct_ids"),
            )
        )
    return counts.withColumn("duplicate_rows", F.col("stored") - F.col("distinct_ids"))
