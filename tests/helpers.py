from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in a fixed order, as tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def day(n: int) -> date:
    return date(2024, 1, 1) + timedelta(days=n)


def noon(n: int, hours: int = 12) -> datetime:
    return datetime(2024, 1, 1, hours) + timedelta(days=n)


def price_rows(symbol: str, prices: list[float | None]) -> list[tuple]:
    """One raw price per day."""
    return [
        (symbol, price, "US", noon(i), noon(i, 13), day(i), "feed") for i, price in enumerate(prices)
    ]
