"""History coverage (distinct series and days) from monthly states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.distincts import bitmap_states, distinct_counts, extend_dictionary, merge_states

SERIES, DAYS = "series", "days"


def coverage_states(daily: DataFrame, key: str, day: str, dictionary: DataFrame | None = None) -> DataFrame:
    """(month, counted, _bucket, _bits) of a table with one row per series and date.

    ``dictionary`` (key, number) must hold every key; without one it is built here.
    To be kept between runs, it has to be written and handed in again. Rows without
    a date fall in the null month; null keys are not counted.
    """
    dictionary = extend_dictionary(daily, key) if dictionary is None else dictionary
    counted = F.explode(
        F.array(
            F.struct(F.lit(SERIES).alias("counted"), F.col("number")),
            F.struct(F.lit(DAYS).alias("counted"), F.unix_date(day).cast("long").alias("number")),
        )
    )
    month = F.to_date(F.date_trunc("month", day)).alias("month")
    numbers = daily.select(key, day).join(dictionary, key, "left").select(month, counted.alias("c"))
    return bitmap_states(numbers.select("month", "c.*"), ["month", "counted"], F.col("number"))


def replace_months(states: DataFrame, fresh: DataFrame, months: DataFrame) -> DataFrame:
    """Kept states of all but the given ``months(month)``, with the fresh ones of those."""
    touched = months.select(F.col("month").alias("_month")).distinct()
    kept = states.join(touched, states["month"].eqNullSafe(touched["_month"]), "left_anti")
    return kept.unionByName(fresh)


def coverage_report(states: DataFrame) -> DataFrame:
    """(level, period, series, days) for every month and year, and for all."""

    def level(name: str, period: Column) -> DataFrame:
        merged = merge_states(states, [period.alias("period"), F.col("counted")])
        return (
            distinct_counts(merged, ["period", "counted"], "n")
            .groupBy("period")
            .agg(*[F.coalesce(F.sum(F.when(F.col("counted") == c, F.col("n"))), F.lit(0)).alias(c) for c in (SERIES, DAYS)])
            .select(F.lit(name).alias("level"), "period", SERIES, DAYS)
        )

    months = level("month", F.date_format("month", "yyyy-MM"))
    years = level("year", F.date_format("month", "yyyy"))
    return months.unionByName(years).unionByName(level("all", F.lit("all")))
