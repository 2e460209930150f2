"""Column expressions shared by the signal builders."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

TRADING_DAYS = 252.0


#: Numbers of units below this are rounded as doubles; their error is far below ``TIE``.
PLAIN_UNITS, TIE = 1e9, 1e-6


def rounded(value: Column, digits: int) -> Column:
    """``F.round`` of a double, the same to the last bit, in a fraction of its time.

    ``F.round`` writes the number out in decimal and reads it back. The nearest whole
    number of units, divided by the units, is the same double, unless the number is near
    a tie or so large that a unit is near its last bits; those go to ``F.round``. The zero
    that is added turns minus zero into zero. ``value`` is named several times, so it had
    better be a column of its own.
    """
    units = float(10**digits)
    scaled = value * units
    off_tie = F.abs(scaled - F.floor(scaled) - 0.5) > TIE
    plain = (F.rint(scaled) + 0.0) / units
    return F.when((F.abs(scaled) < PLAIN_UNITS) & off_tie, plain).otherwise(F.round(value, digits))


def relative_change(value: Column, base: Column) -> Column:
    """Change against ``base`` in percent, not rounded; null when the base is null or zero."""
    return F.try_divide(value - base, base) * 100


def pct_change(value: Column, base: Column, digits: int) -> Column:
    """Change against ``base`` in percent; null when the base is null or zero."""
    return F.round(relative_change(value, base), digits)


def abs_change(value: Column, base: Column, digits: int) -> Column:
    return F.round(value - base, digits)


def annual_deviation(pct: Column, frame: WindowSpec) -> Column:
    """Annualised sample deviation of the (already rounded) daily changes, not rounded."""
    return F.stddev_samp(pct).over(frame) * F.sqrt(F.lit(TRADING_DAYS))


def rolling_volatility(pct: Column, frame: WindowSpec, digits: int) -> Column:
    """Annualised sample deviation of the (already rounded) daily changes."""
    return F.round(annual_deviation(pct, frame), digits)


def any_of(*conditions: Column) -> Column:
    """True if one condition holds, false if none does or all are unknown."""
    return F.coalesce(reduce(or_, conditions), F.lit(False))


def as_exact(value: Column, digits: int) -> Column:
    """A metric rounded to ``digits`` as a decimal; null if it does not fit."""
    return value.try_cast(DecimalType(26 + digits, digits))


#: Whole numbers below this are exact as doubles.
EXACT = float(2**53)


def mean_state(value: Column, digits: int) -> dict[str, Column]:
    """Aggregates that a mean is made of, each a sum, so that the states of parts add up.

    ``n`` counts the values. ``whole`` sums a metric that has ``digits`` decimals, as a
    rule, in units of its last decimal: whole numbers, whose sum as a double is exact up
    to 2^53 whatever the order in which partial sums meet. What a value has beyond its
    decimals is summed beside them as ``rest``, unless it is less than a millionth of a
    unit, as the double nearest to a decimal has. Values too large for units, infinite
    ones and NaN are summed as they are in ``large``, as a plain mean would.
    """
    plain = value.cast("double")
    scaled = plain * float(10**digits)
    fits = F.abs(scaled) < EXACT
    off = scaled - F.rint(scaled)
    return {
        "n": F.count(value),
        "whole": F.sum(F.when(fits, F.rint(scaled)).otherwise(0.0)),
        "rest": F.sum(F.when(fits & (F.abs(off) > 1e-6), off).otherwise(0.0)),
        "large": F.sum(F.when(~fits, plain).otherwise(0.0)),
    }


def mean_of(state: Mapping[str, Column], digits: int) -> Column:
    """The mean from (sums of) :func:`mean_state`; null where there is no value."""
    units = float(10**digits)
    return F.try_divide((state["whole"] + state["rest"]) / units + state["large"], state["n"])


def exact_avg(value: Column, digits: int) -> Column:
    """Mean of a metric that has ``digits`` decimals, the same in whatever order."""
    return mean_of(mean_state(value, digits), digits)
