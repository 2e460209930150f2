"""Latest row per key, latest date of a table, first k rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.sources.schemas import MONTH


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the greatest ``order`` value per key.

    ``tiebreak`` makes the order total, so that a rerun keeps the same row. Spark
    turns ``row_number() = 1`` into a group limit ahead of the shuffle: a map
    task sends one row per key, however many copies of a key it holds.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in (*order, *tiebreak)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_value(df: DataFrame, column: str) -> Column:
    """The greatest value of a column, as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def latest_rows(df: DataFrame, date_column: str) -> DataFrame:
    """Rows of the newest date.

    A frame that still has its table's month, the partition of its files, is first
    cut to the newest month, which takes no data but the partitions' names.
    """
    if MONTH in df.columns:
        df = df.filter(F.col(MONTH) == latest_value(df, MONTH)).drop(MONTH)
    return df.filter(F.col(date_column) == latest_value(df, date_column))


def ascending(column: str) -> Column:
    """Nulls first, as Spark sorts by default; said, because engines differ."""
    return F.col(column).asc_nulls_first()


def descending(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_last()


def top_rows(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows by ``order``; every task forwards at most ``k`` rows."""
    return df.orderBy(*order).limit(k)
