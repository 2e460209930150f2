"""Moving aggregates over more rows than a task should hold.

The frame of a row is its last ``rows`` rows. With blocks of ``block_rows`` rows it
falls into three parts: the rows of the row's own block up to itself, a stretch of
earlier rows that is the same for the whole block, and a few rows at its far end,
fewer than a block. So each block is handed one copy of as many rows as it has
itself, those at which its frames begin, and the stretch between comes from a table
with one row per block. Every row is copied once, whatever the frame's length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.series import BLOCK_ROWS, positions

#: Blocks in a frame at most, unless the caller sets the size of a block.
FRAME_BLOCKS = 64
STATE = ("n", "sum", "squares", "high", "low")


def _states(unit: Column) -> dict[str, Column]:
    """What a row adds to each part of a state."""
    wide = unit.cast("decimal(38,0)")
    return {
        "n": unit.isNotNull().cast("long"),
        "sum": F.coalesce(wide, F.lit(0).cast("decimal(38,0)")),
        "squares": F.coalesce((unit.cast("decimal(19,0)") * unit.cast("decimal(19,0)")).cast("decimal(38,0)"),
                              F.lit(0).cast("decimal(38,0)")),
        "high": unit,
        "low": unit,
    }


def _total(part: str, values: Column) -> Column:
    if part in ("high", "low"):
        return (F.max if part == "high" else F.min)(values)
    return F.sum(values)


def _merged(part: str, *values: Column) -> Column:
    if part in ("high", "low"):
        return (F.greatest if part == "high" else F.least)(*values)
    # Exact: an overflow raises instead of losing digits.
    zero = F.lit(0).cast("long" if part == "n" else "decimal(38,0)")
    return sum((F.coalesce(v, zero) for v in values[1:]), F.coalesce(values[0], zero)).cast(
        "long" if part == "n" else "decimal(38,0)"
    )


def moving_state(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    coarse: Column,
    fine: Column,
    value: Column,
    digits: int,
    rows: int,
    block_rows: int | None = None,
) -> DataFrame:
    """Add count, sum, squares, high and low of each row's last ``rows`` rows.

    ``value`` is counted in units of its last decimal (``digits``), so every part is
    exact: ``frame_n`` (rows with a value), ``frame_sum`` and ``frame_squares`` in units
    and squared units, ``frame_high`` and ``frame_low`` in units. ``coarse`` and
    ``fine`` as in ``positions``. Near the start of a series the frame is shorter. A
    value that does not fit a long of units raises; so does NaN or an infinity.
    """
    size = block_rows or max(BLOCK_ROWS, rows // FRAME_BLOCKS)
    if rows <= size:
        raise ValueError("a frame this short needs no blocks: use over_long_series")
    unit = F.round(value.cast("double") * F.lit(float(10**digits))).cast("long")
    placed = positions(df, keys, order, coarse, fine).withColumns(
        {"_unit": unit, "_block": F.floor(F.col("_position") / size)}
    )
    row = F.struct(*df.columns)
    own = placed.select(*keys, "_block", F.col("_position").alias("_at"), F.lit(True).alias("_own"), "_unit",
                        row.alias("_row"))
    # The row whose frame begins here lies rows - 1 further on.
    at = F.col("_position") + (rows - 1)
    begins = placed.select(*keys, F.floor(at / size).alias("_block"), at.alias("_at"), F.lit(False).alias("_own"),
                           "_unit", F.lit(None).cast(own.schema["_row"].dataType).alias("_row"))
    block = Window.partitionBy(*keys, "_block")
    up = block.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = block.orderBy("_at").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    parts = _states(F.col("_unit"))
    near = {f"_near_{p}": _total(p, F.when(F.col("_own"), c)).over(up) for p, c in parts.items()}
    far = {f"_far_{p}": _total(p, F.when(~F.col("_own"), c)).over(down) for p, c in parts.items()}
    framed = own.unionByName(begins).withColumns(near | far).filter("_own")

    between = _between(placed, keys, rows, size)
    if between is None:
        states = {f"frame_{p}": _merged(p, F.col(f"_near_{p}"), F.col(f"_far_{p}")) for p in STATE}
        return framed.select("_row.*", *[c.alias(n) for n, c in states.items()])
    between = between.withColumnsRenamed({c: f"_of{c}" for c in [*keys, "_block"]})
    same = [framed[c].eqNullSafe(between[f"_of{c}"]) for c in [*keys, "_block"]]
    joined = framed.join(between, reduce(and_, same), "left")
    states = {
        f"frame_{p}": _merged(p, F.col(f"_near_{p}"), F.col(f"_far_{p}"), F.col(f"_mid_{p}")) for p in STATE
    }
    return joined.select("_row.*", *[c.alias(n) for n, c in states.items()])


def _between(placed: DataFrame, keys: Sequence[str], rows: int, size: int) -> DataFrame | None:
    """Per block, the state of the rows that lie in all of its frames and ahead of it.

    They begin ``rows - 1 - size`` rows ahead of the block, always at the same place
    of an earlier block; so that block gives the state of its tail from there, and
    the blocks after it give theirs whole.
    """
    reach = rows - 1 - size
    if reach == 0:
        return None
    back = -(-reach // size)
    cut = back * size - reach
    parts = _states(F.col("_unit"))
    in_tail = F.col("_position") % size >= cut
    blocks = placed.groupBy(*keys, "_block").agg(
        *[_total(p, c).alias(f"_all_{p}") for p, c in parts.items()],
        *[_total(p, F.when(in_tail, c)).alias(f"_tail_{p}") for p, c in parts.items()],
    )
    along = Window.partitionBy(*keys).orderBy("_block")
    middle = {}
    for p in STATE:
        tail = F.lag(f"_tail_{p}", back).over(along)
        if back > 1:
            whole = _total(p, F.col(f"_all_{p}")).over(along.rowsBetween(1 - back, -1))
            tail = _merged(p, tail, whole)
        middle[f"_mid_{p}"] = tail
    return blocks.select(*keys, "_block", *[c.alias(n) for n, c in middle.items()])


def mean_of_state(digits: int) -> Column:
    return F.try_divide(F.col("frame_sum").cast("double"), F.col("frame_n")) / float(10**digits)


def deviation_of_state(digits: int) -> Column:
    """Sample deviation; null for fewer than two values."""
    n = F.col("frame_n").cast("decimal(10,0)")
    spread = (n * F.col("frame_squares").cast("decimal(27,0)")).cast("decimal(38,0)") - (
        F.col("frame_sum").cast("decimal(19,0)") * F.col("frame_sum").cast("decimal(19,0)")
    ).cast("decimal(38,0)")
    pairs = (F.col("frame_n") * (F.col("frame_n") - 1)).cast("double")
    deviation = F.sqrt(spread.cast("double") / pairs) / float(10**digits)
    return F.when(F.col("frame_n") > 1, deviation)
