"""Row-offset windows over series of any length."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], coarse: Column, fine: Column) -> DataFrame:
    """Add ``_position``, the row's number in its series, from 0.

    ``coarse`` and ``fine`` grow with ``order`` (say, the hour and the second). Rows
    are numbered within their fine slot; the rows of the slots ahead are counted
    per fine slot of a coarse one and per coarse slot of the series. So no task
    sorts more than one fine slot of one series.
    """
    slots = [*keys, "_coarse", "_fine"]
    slotted = df.withColumns({"_coarse": coarse, "_fine": fine})

    def before(column: str, by: Sequence[str], along: str) -> Column:
        window = Window.partitionBy(*by).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    counts = slotted.groupBy(*slots).agg(F.count(F.lit(1)).alias("_n"))
    inner = counts.withColumn("_inner", before("_n", [*keys, "_coarse"], "_fine")).drop("_n")
    outer = counts.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
    outer = outer.withColumn("_outer", before("_n", keys, "_coarse")).drop("_n")
    starts = _matched(inner, outer, [*keys, "_coarse"])
    rank = F.row_number().over(Window.partitionBy(*slots).orderBy(*order)) - 1
    numbered = _matched(slotted.withColumn("_rank", rank), starts, slots)
    place = F.col("_outer") + F.col("_inner") + F.col("_rank")
    return numbered.withColumn("_position", place).drop("_coarse", "_fine", "_rank", "_inner", "_outer")


def _matched(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """An inner join in which null keys match."""
    renamed = right.withColumnsRenamed({c: f"_of{c}" for c in columns})
    on = reduce(and_, [left[c].eqNullSafe(renamed[f"_of{c}"]) for c in columns])
    return left.join(renamed, on).drop(*[f"_of{c}" for c in columns])


def over_long_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    coarse: Column,
    fine: Column,
    look_back: int,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Run windows that look back at most ``look_back`` rows, series by series.

    ``compute(frame, partition)`` adds the window columns, partitioning by the
    given columns. Partitioning by the series key alone would put a whole series
    into one task. Here a series is cut into blocks of ``block_rows`` rows, and each
    block is handed copies of the ``look_back`` rows ahead of it, which are dropped
    once the windows ran. One pass computes every row; the result equals windows
    over whole series.
    """
    if look_back > block_rows:
        raise ValueError("a block must hold the rows that are looked back at")
    own = F.floor(F.col("_position") / block_rows)
    closing = F.col("_position") % block_rows >= block_rows - look_back
    placed = positions(df, keys, order, coarse, fine).withColumn("_own", own)
    dealt = placed.withColumn(
        "_block", F.explode(F.when(closing, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    computed = compute(dealt, [*keys, "_block"]).filter("_own = _block")
    return computed.drop("_position", "_own", "_block")
