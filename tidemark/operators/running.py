"""Running aggregates over a global order, without a single-partition sort.

A window with no ``PARTITION BY`` puts every row in one task, and a window per
key does the same to a hot key. Here the order is cut into blocks by columns
derived from the data. Each block is reduced to one value, the (few) block
values are scanned to give every block the value carried in from the left, and
rows then only need a window inside their own block. Blocks nest, so the block
values themselves are reduced the same way and no level ever gathers more than
its fan-out of rows in one group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096

_AGGREGATE = {"max": F.max, "min": F.min, "sum": F.sum}
_COMBINE = {
    "max": F.greatest,
    "min": F.least,
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
}


def blocks_of(position: Column, block_rows: int = BLOCK_ROWS, levels: int = 2) -> list[list[Column]]:
    """Nested blocks over a BIGINT position, coarsest first.

    With the default fan-out, 10^12 positions leave 60,000 blocks at the top.
    """
    position = position.cast("bigint")
    sizes = [block_rows**power for power in range(levels, 0, -1)]
    return [[_div(position, size)] for size in sizes]


def _div(position: Column, size: int) -> Column:
    # Integer arithmetic: "/" would go through DOUBLE and lose large offsets.
    return F.call_function("div", position, F.lit(size).cast("bigint"))


def topic_blocks(
    slice_: Column, offset: Column, *source: Column, block_rows: int = BLOCK_ROWS,
) -> list[list[Column]]:
    """Nested blocks for the order (slice, *source, offset) of topic messages.

    ``slice_`` is a short stretch of broker time, ``source`` names the topic and
    partition. A burst within one slice is still split, by offset; slices are
    gathered day by day first, as one tick may hold the whole topic.
    """
    inside = [[slice_], [*source, _div(offset.cast("bigint"), block_rows)]]
    return [[F.date_trunc("DAY", slice_)], *inside]


def running(
    df: DataFrame,
    value: Column,
    out: str,
    *,
    order: Sequence[str],
    levels: Sequence[Sequence[Column]],
    how: str = "max",
    partition_by: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """Add ``out`` = aggregate of ``value`` over the rows before each row.

    ``levels`` are block columns, coarsest first, each a non-decreasing function
    of ``order``; ``partition_by`` columns restart the aggregate. Rows without a
    position (NULL in either) have no place in the order and are left out. With
    ``inclusive`` the row itself counts too.
    """
    aggregate, combine = _AGGREGATE[how], _COMBINE[how]
    columns = df.columns
    named: list[list[str]] = []
    for depth, level in enumerate(levels):
        names = [f"__b{depth}_{index}" for index in range(len(level))]
        df = df.withColumns(dict(zip(names, level, strict=True)))
        named.append(names)
    df = df.withColumn("__value", value)

    def key(depth: int) -> list[str]:
        return [*partition_by, *[name for names in named[:depth] for name in names]]

    def carried(blocks: DataFrame, depth: int) -> DataFrame:
        """``blocks``: one row per block of level ``depth`` with its __value."""
        window = (
            Window.partitionBy(*key(depth))
            .orderBy(*named[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        inner = blocks.select(*key(depth + 1), aggregate("__value").over(window).alias("__carry"))
        if depth == 0:
            return inner
        parents = blocks.groupBy(*key(depth)).agg(aggregate("__value").alias("__value"))
        outer = carried(parents, depth - 1).withColumnRenamed("__carry", "__outer")
        return inner.join(outer, key(depth)).select(
            *key(depth + 1), combine(F.col("__outer"), F.col("__carry")).alias("__carry")
        )

    finest = key(len(named))
    # The joins below would add these filters one by one, on some branches only;
    # stated once, all branches share one aggregation of the rows.
    df = df.where(reduce(and_, [F.col(name).isNotNull() for name in finest]))
    blocks = df.groupBy(*finest).agg(aggregate("__value").alias("__value"))
    carry = carried(blocks, len(named) - 1)
    window = (
        Window.partitionBy(*finest)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        df.join(carry, finest)
        .withColumn(out, combine(F.col("__carry"), aggregate("__value").over(window)))
        .select(*columns, out)
    )
