"""As-of join that returns rows, for series of any length.

Both sides are united and put into time order, series by series; a left row takes
what the right row last met ahead of it holds. A series is cut into blocks of
``block_rows`` rows, so no task holds more than a block. What a block has to know of
the blocks ahead of it is one row: a small table of block ends passes the carry on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.series import BLOCK_ROWS, positions


def asof_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    right_order: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every left row with the columns of its right row, null where there is none.

    The right row is the last one of the same keys whose ``right_time`` is at or
    before ``left_time``; of several with that time the last by ``right_order``, then
    by the remaining columns. Keys that are null match each other. A left row
    without a time finds nothing, a right row without one is never found. Columns of
    both sides other than the keys must have different names.

    Rows are numbered by hour and second (see ``positions``), so one second of one
    series is the most that is sorted in one task.
    """
    held = [c for c in right.columns if c not in keys]
    ties = [*right_order, *[c for c in held if c not in (right_time, *right_order)]]
    kept = [c for c in left.columns if c not in keys]
    asked = left.select(
        *keys,
        F.col(left_time).cast("timestamp").alias("_time"),
        F.lit(1).alias("_side"),
        F.struct(*kept).alias("_left"),
        F.lit(None).cast(right.select(F.struct(right_time, *ties)).schema[0].dataType).alias("_right"),
    )
    told = right.filter(F.col(right_time).isNotNull()).select(
        *keys,
        F.col(right_time).cast("timestamp").alias("_time"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(asked.schema["_left"].dataType).alias("_left"),
        F.struct(right_time, *ties).alias("_right"),
    )
    # At one time the right rows come first, so that a left row of that time sees them.
    order = ["_time", "_side", "_right"]
    placed = positions(
        asked.filter("_time IS NOT NULL").unionByName(told),
        keys,
        order,
        F.date_trunc("hour", "_time"),
        F.date_trunc("second", "_time"),
    ).withColumn("_block", F.floor(F.col("_position") / block_rows))

    ahead = Window.partitionBy(*keys, "_block").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("_found", F.last("_right", ignorenulls=True).over(ahead)).filter("_side = 1")
    carried = block_carry(placed, keys).withColumnsRenamed({c: f"_of{c}" for c in [*keys, "_block"]})
    same = [inside[c].eqNullSafe(carried[f"_of{c}"]) for c in [*keys, "_block"]]
    joined = inside.join(carried, reduce(and_, same), "left")
    untimed = asked.filter("_time IS NULL").withColumn("_found", F.col("_right"))
    found = (
        joined.withColumn("_found", F.coalesce("_found", "_carry"))
        .select(*keys, "_left", "_found")
        .unionByName(untimed.select(*keys, "_left", "_found"))
    )
    return found.select(
        *[F.col(c) if c in keys else F.col("_left")[c].alias(c) for c in left.columns],
        *[F.col("_found")[c].alias(c) for c in held],
    )


def block_carry(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per block, the right row that the blocks ahead of it end with.

    One row per block goes through the window, of a series at most its length over
    ``block_rows``.
    """
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy(*keys, "_block").agg(
        F.max_by("_right", F.when(F.col("_right").isNotNull(), F.col("_position"))).alias("_end")
    )
    return ends.select(*keys, "_block", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
