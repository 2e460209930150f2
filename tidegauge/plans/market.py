"""Daily market snapshot: returns, volatility, drawdown and stress per symbol."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.metrics import annual_deviation, any_of, relative_change, rounded
from tidegauge.operators.latest import dedupe_latest
from tidegauge.sources.schemas import MONTH, columns_of


@dataclass(frozen=True)
class MarketStress:
    day_change_pct: float = -2.0
    return_30d_pct: float = -5.0
    volatility: float = 25.0
    drawdown_pct: float = -10.0


def daily_closes(prices: DataFrame) -> DataFrame:
    """Last price per symbol and day, of one time stamp the last ingested one.

    Takes Silver rows or typed raw rows: copies of a time stamp fall to the same
    rule as in Silver, so a build straight from raw needs one collapse, not two.
    """
    dated = prices.withColumns({"snapshot_date": F.to_date("market_time"), "latest_price": F.col("price")}).filter(
        F.col("snapshot_date").isNotNull()
    )
    return dedupe_latest(
        dated, ["symbol", "snapshot_date"], ["market_time"], ["ingested_at", "latest_price", "currency"]
    )


#: Rows that one symbol may bring to a task as they are.
CROWDED_ROWS = 500_000


def by_symbol(prices: DataFrame) -> DataFrame:
    """The rows dealt by symbol, so that the daily closes and the windows over them take one
    shuffle, not two. Symbols of many ticks are found by a count and come with the last
    row of a day only, collapsed where the rows lie; there are at most as many of them as
    the rows hold times ``CROWDED_ROWS``."""
    many = prices.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWDED_ROWS)
    crowded = [r["symbol"] for r in many.select("symbol").collect()]
    if not crowded:
        return prices.repartition("symbol")
    hot = F.coalesce(F.col("symbol").isin(crowded), F.lit(False))
    last = dedupe_latest(
        prices.filter(hot).withColumn("_day", F.to_date("market_time")),
        ["symbol", "_day"], ["market_time"], ["ingested_at", "price", "currency"],
    ).drop("_day")
    return prices.filter(~hot).unionByName(last).repartition("symbol")


# The 90-row high is the greatest of nine 10-row highs.
HIGH_BLOCK, HIGH_BLOCKS = 10, 9
#: Observations that the returns go back.
RETURNS = (7, 30, 90)
#: Changes of a close and their decimals.
CHANGES = {"day_change": 6, "day_change_pct": 4, **{f"return_{n}d_pct": 4 for n in RETURNS}}


def market_closes(prices: DataFrame) -> DataFrame:
    """One row per symbol and day: the closes that a snapshot row is made of, as typed.

    Only daily closes reach the windows per symbol, so a series is at most as long
    as the calendar, however many ticks or copies the symbol has. All that rows say
    beside the volatility follows from a row alone (:func:`snapshot_of`), so a build that
    deals rows to months sends these: prices as decimals pack into half the bytes of
    rounded doubles.
    """
    series = Window.partitionBy("symbol").orderBy("snapshot_date")
    close = F.col("latest_price")

    # A sliding frame is evaluated row by row: ten steps and nine look-ups a row
    # instead of ninety steps. Look-ups ahead of the series are null and ignored.
    high = F.greatest(
        *[F.lag("_block_high", i * HIGH_BLOCK).over(series) for i in range(HIGH_BLOCKS)]
    )
    return (
        daily_closes(prices)
        .withColumns(
            {
                "open_price": F.lag(close, 1).over(series),
                **{f"_close_{n}": F.lag(close, n).over(series) for n in RETURNS},
                "_block_high": F.max(close).over(series.rowsBetween(1 - HIGH_BLOCK, 0)),
            }
        )
        .withColumn("day_change_pct", relative_change(close.cast("double"), F.col("open_price").cast("double")))
        .withColumn("day_change_pct", rounded(F.col("day_change_pct"), CHANGES["day_change_pct"]))
        .withColumns(
            {
                "rolling_30d_volatility": annual_deviation(
                    F.col("day_change_pct"), series.rowsBetween(-29, 0)
                ),
                "_high": high,
            }
        )
        .withColumn("rolling_30d_volatility", rounded(F.col("rolling_30d_volatility"), 4))
        .select(
            "symbol", "snapshot_date", "latest_price", "open_price", *[f"_close_{n}" for n in RETURNS], "_high",
            "rolling_30d_volatility", "currency", "market_time", "ingested_at",
        )
    )


def snapshot_of(closes: DataFrame, stress: MarketStress = MarketStress()) -> DataFrame:
    """Snapshot rows from :func:`market_closes`, each from its row alone; a month that the
    frame has stays."""
    prices = ("latest_price", "open_price", *[f"_close_{n}" for n in RETURNS], "_high")
    # Each change is a column of its own ahead of its rounding, which names it several times.
    close, previous = F.col("latest_price"), F.col("open_price")
    return (
        closes.withColumns({name: F.col(name).cast("double") for name in prices})
        .withColumns(
            {
                "day_change": close - previous,
                "day_change_pct": relative_change(close, previous),
                **{f"return_{n}d_pct": relative_change(close, F.col(f"_close_{n}")) for n in RETURNS},
                "drawdown_from_90d_high_pct": relative_change(close, F.col("_high")),
            }
        )
        .withColumns(
            {name: rounded(F.col(name), digits) for name, digits in (CHANGES | {"drawdown_from_90d_high_pct": 4}).items()}
        )
        .withColumn(
            "stress_flag",
            any_of(
                F.col("day_change_pct") <= stress.day_change_pct,
                F.col("return_30d_pct") <= stress.return_30d_pct,
                F.col("rolling_30d_volatility") >= stress.volatility,
                F.col("drawdown_from_90d_high_pct") <= stress.drawdown_pct,
            ),
        )
        .select(*columns_of("daily_market_snapshot"), *[c for c in closes.columns if c == MONTH])
    )


def market_snapshot(prices: DataFrame, stress: MarketStress = MarketStress()) -> DataFrame:
    """One row per symbol and day; offsets count observed days, not calendar days."""
    return snapshot_of(market_closes(prices), stress)
