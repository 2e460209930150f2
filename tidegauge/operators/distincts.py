"""Exact distinct counts from states that merge.

Keys get dense numbers from a dictionary, dates are numbers already. The state of a
period is a set of bitmaps, one row per 32,768 numbers that occur; the states of
months make those of years and of everything by OR, so no report reads the rows
again, and a month that changes is the only one to be built anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots that number their keys side by side.
SLOTS = 1024


def extend_dictionary(keys: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``known`` (column, number) with numbers for the keys it lacks.

    A key keeps its number for ever. Keys are numbered within ``SLOTS`` slots of
    their hash, so no task sees them all, and numbers stay dense: a slot's first key
    has the slot's own number, the next one ``SLOTS`` more. A null key gets no number.
    """
    fresh = keys.select(column).filter(F.col(column).isNotNull()).distinct()
    slot = F.pmod(F.xxhash64(column), F.lit(SLOTS)).alias("_slot")
    order = Window.partitionBy("_slot").orderBy(column)
    if known is None:
        numbered = fresh.select(column, slot).withColumn("_rank", F.row_number().over(order) - 1)
        return numbered.select(column, (F.col("_rank") * SLOTS + F.col("_slot")).alias("number"))
    used = known.groupBy(F.pmod("number", F.lit(SLOTS)).alias("_slot")).agg(F.count(F.lit(1)).alias("_used"))
    added = (
        fresh.join(known, column, "left_anti")
        .select(column, slot)
        .withColumn("_rank", F.row_number().over(order) - 1)
        .join(used, "_slot", "left")
        .select(
            column,
            ((F.col("_rank") + F.coalesce("_used", F.lit(0))) * SLOTS + F.col("_slot")).alias("number"),
        )
    )
    return known.select(column, "number").unionByName(added)


def bitmap_states(numbers: DataFrame, by: Sequence[str], number: Column) -> DataFrame:
    """``by`` + (_bucket, _bits): the numbers that occur, null ones left out.

    Partial bitmaps are combined ahead of the shuffle; a bitmap is 4 KB, and a
    group has one per 32,768 numbers.
    """
    return (
        numbers.select(*by, number.cast("long").alias("_number"))
        .filter("_number IS NOT NULL")
        .groupBy(*by, F.bitmap_bucket_number("_number").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_bits"))
    )


def merge_states(states: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """States of larger groups from those of smaller ones."""
    return states.groupBy(*by, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def distinct_counts(states: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct numbers per group."""
    return states.groupBy(*by).agg(F.sum(F.bitmap_count("_bits")).alias(name))
