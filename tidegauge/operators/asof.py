"""Aggregates over the state of many series as of each date.

The state of a series on a date is its last observation on or before that date.
Joining every date with every series would cost dates x series rows. Here an
observation contributes the *difference* to the one it replaces, the differences
are summed per date, and a running sum over dates gives the aggregate: one row
per observation, then one row per calendar date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.metrics import as_exact


def _step(current: Column, series) -> Column:
    """What an observation adds on top of its predecessor's contribution."""
    return current - F.coalesce(F.lag(current).over(series), F.lit(0))


def changes_by_date(
    df: DataFrame,
    keys: Sequence[str],
    date_column: str,
    counts: Mapping[str, Column],
    means: Mapping[str, tuple[str, int]],
    only: Column | None = None,
) -> DataFrame:
    """Per date, how the as-of aggregates move.

    ``counts`` maps a name to a condition on the current observation; ``means``
    maps a name to a metric and the decimals it is rounded to. Needs one row per
    series and date. A series window then holds at most one row per calendar day.
    A metric of 1e26 or more counts as infinite. Rows for which ``only`` does not hold
    are compared with, but move nothing.
    """
    series = Window.partitionBy(*keys).orderBy(date_column)
    steps = {
        name: _step(F.coalesce(condition, F.lit(False)).cast("long"), series)
        for name, condition in counts.items()
    }
    for name, (metric, digits) in means.items():
        value = F.col(metric)
        exact = as_exact(value, digits)
        endless = value.isNotNull() & exact.isNull() & ~F.isnan(value)
        steps[f"{name}__n"] = _step(value.isNotNull().cast("long"), series)
        # A decimal sum: a value that is replaced leaves nothing behind.
        steps[f"{name}__sum"] = _step(F.coalesce(exact, F.lit(0).cast(f"decimal({26 + digits},{digits})")), series)
        # No number can be added to these, so they are counted.
        steps[f"{name}__nan"] = _step(F.coalesce(F.isnan(value), F.lit(False)).cast("long"), series)
        steps[f"{name}__up"] = _step(F.coalesce(endless & (value > 0), F.lit(False)).cast("long"), series)
        steps[f"{name}__down"] = _step(F.coalesce(endless & (value < 0), F.lit(False)).cast("long"), series)
    counted = F.lit(True) if only is None else only
    return (
        df.select(F.col(date_column).alias("as_of_date"), counted.alias("_counted"), *[c.alias(n) for n, c in steps.items()])
        .filter("_counted")
        .groupBy("as_of_date")
        .agg(*[F.sum(name).alias(name) for name in steps])
    )


def read_as_of(
    spine: DataFrame, changes: DataFrame, counts: Sequence[str], means: Sequence[str]
) -> DataFrame:
    """Add the as-of aggregates to every row of ``spine(as_of_date, ...)``.

    Both inputs hold one row per calendar date, which bounds the unpartitioned
    running sum. Dates ahead of the first observation get zero counts and null
    means.
    """
    so_far = Window.orderBy("as_of_date").rangeBetween(Window.unboundedPreceding, 0)
    steps = [c for c in changes.columns if c != "as_of_date"]
    running = (
        spine.withColumn("_asked", F.lit(True))
        .unionByName(changes, allowMissingColumns=True)
        .withColumns({c: F.coalesce(F.sum(c).over(so_far), F.lit(0)) for c in steps})
        .filter("_asked")
    )

    def mean(name: str) -> Column:
        nan, up, down = (F.col(f"{name}__{kind}") > 0 for kind in ("nan", "up", "down"))
        plain = F.try_divide(F.col(f"{name}__sum").cast("double"), F.col(f"{name}__n"))
        return (
            F.when(nan | (up & down), F.lit(float("nan")))
            .when(up, F.lit(float("inf")))
            .when(down, F.lit(float("-inf")))
            .otherwise(plain)
        )

    return running.select(
        *spine.columns, *counts, *[mean(name).alias(name) for name in means]
    )
