"""Instrument symbols such as ``SPY.US``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbols whose vendor ticker is not the part before the dot.
VENDOR_TICKERS = {
    "VIX.US": "^VIX",
    "DXY.US": "DX-Y.NYB",
}


def suffix_or_us(symbol: Column) -> Column:
    """Last dotted part, ``US`` for a symbol without a dot."""
    return F.when(F.contains(symbol, F.lit(".")), F.substring_index(symbol, ".", -1)).otherwise(
        F.lit("US")
    )


def second_part(symbol: Column) -> Column:
    """Second dotted part, null for a symbol without a dot."""
    return F.try_element_at(F.split(symbol, r"\."), F.lit(2))


def map_ticker(symbol: Column, tickers: dict[str, str] | None = None) -> Column:
    """Vendor ticker: the mapped one, else the upper-cased part before the dot."""
    plain = F.upper(F.substring_index(symbol, ".", 1))
    pairs = [F.lit(part) for pair in (tickers or VENDOR_TICKERS).items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), symbol), plain)


def history_variants(symbol: Column) -> Column:
    """Spellings under which a history may have been landed, best one first."""
    name = F.trim(F.lower(symbol))
    variants = F.array(
        name,
        F.when(F.endswith(name, F.lit(".us")), F.left(name, F.length(name) - 3)),
        F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", 1)),
    )
    return F.array_distinct(F.filter(variants, lambda v: v.isNotNull() & (v != "")))
