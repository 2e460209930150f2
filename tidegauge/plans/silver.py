"""Raw rows to typed rows with one row per business key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.latest import dedupe_latest
from tidegauge.sources.schemas import columns_of

# Business keys, which the duplicate check uses as well.
MARKET_KEY = ("symbol", "market_time")
FX_KEY = ("base_currency", "quote_currency", "rate_timestamp")
MACRO_KEY = ("country_code", "indicator_name", "observation_date")


def _present(*columns: str) -> Column:
    """All columns set; written out so that the scan can skip row groups by it."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def typed_prices(bronze: DataFrame, price_type: str = "decimal(12,4)") -> DataFrame:
    """Usable prices; one that does not fit the type is dropped like a missing one."""
    return bronze.withColumn("price", F.col("price").try_cast(price_type)).filter(
        _present(*MARKET_KEY, "price")
    )


def merge_market(typed: DataFrame) -> DataFrame:
    """The last ingested price per symbol and time. What it leaves of two sets of rows
    it leaves of their own last ones, so Silver rows and new ones merge by it."""
    return dedupe_latest(typed, MARKET_KEY, ["ingested_at"], ["price", "currency", "_source", "_ingest_date"])


def clean_market(bronze: DataFrame, price_type: str = "decimal(12,4)") -> DataFrame:
    """Typed prices, the last ingested one per symbol and time."""
    return merge_market(typed_prices(bronze, price_type)).select(*columns_of("market_prices"))


def merge_fx(typed: DataFrame) -> DataFrame:
    """The last ingested rate per pair and time, as :func:`merge_market`."""
    return dedupe_latest(typed, FX_KEY, ["ingested_at"], ["rate", "source_system"])


def clean_fx(
    bronze: DataFrame, rate_type: str = "decimal(12,5)", default_source: str = "frankfurter"
) -> DataFrame:
    """Typed rates, the last ingested one per pair and time.

    Missing rates are dropped ahead of the cast, so a rate that does not fit the
    type stays as a null rate.
    """
    typed = bronze.filter(_present(*FX_KEY, "rate")).withColumns(
        {
            "currency_pair": F.concat("base_currency", "quote_currency"),
            "rate": F.col("rate").try_cast(rate_type),
            "rate_date": F.to_date("rate_timestamp"),
            "source_system": F.coalesce("source_name", F.lit(default_source)),
        }
    )
    return merge_fx(typed).select(*columns_of("fx_rates"))


def typed_indicators(bronze: DataFrame) -> DataFrame:
    """Usable observations.

    A bare year is its first of January; a text that is no date drops the row.
    """
    return bronze.withColumns(
        {
            "observation_date": F.col("observation_date").try_cast("date"),
            "observation_value": F.col("observation_value").cast("double"),
        }
    ).filter(_present(*MACRO_KEY, "observation_value"))


def merge_macro(typed: DataFrame) -> DataFrame:
    """The last ingested observation per series and date, as :func:`merge_market`."""
    return dedupe_latest(
        typed, MACRO_KEY, ["ingest_ts"], ["observation_value", "raw_payload", "_source", "_ingest_date"]
    )


def clean_macro(bronze: DataFrame) -> DataFrame:
    """Dated observations, the last ingested one per series and date."""
    return merge_macro(typed_indicators(bronze)).select(*columns_of("macro_indicators"))
