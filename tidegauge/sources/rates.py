"""Landed FX payloads to rate rows (columns of ``fx_rates_raw``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.sources.payloads import read
from tidegauge.sources.schemas import columns_of

SOURCE_NAME = "frankfurter"


def _rate_rows(df: DataFrame, run_id: str | Column, ingested_at: Column | None) -> DataFrame:
    return df.withColumns(
        {
            # The stamp of a rate is midnight of its date; the session runs in UTC.
            "rate_timestamp": F.try_to_timestamp("_date", F.lit("yyyy-MM-dd")),
            "source_name": F.lit(SOURCE_NAME),
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "run_id": F.lit(run_id) if isinstance(run_id, str) else run_id,
        }
    ).select(*columns_of("fx_rates_raw"))


def parse_fx_latest(
    payloads: DataFrame,
    run_id: str | Column,
    ingested_at: Column | None = None,
    text: str = "payload",
    on_bad: str = "raise",
) -> DataFrame:
    """``{base, date, rates: {quote: rate}}`` with its ``source_url``; null rates stay."""
    rows = read(payloads, "fx_latest", text, on_bad).select(
        "*",
        F.col("_p.base").alias("base_currency"),
        F.col("_p.date").alias("_date"),
        F.explode("_p.rates").alias("quote_currency", "rate"),
    )
    return _rate_rows(rows, run_id, ingested_at)


def parse_fx_range(
    payloads: DataFrame,
    run_id: str | Column,
    ingested_at: Column | None = None,
    text: str = "payload",
    on_bad: str = "raise",
) -> DataFrame:
    """``{base, rates: {date: {quote: rate}}}`` with its ``source_url``."""
    rows = (
        read(payloads, "fx_range", text, on_bad)
        .select(
            "*",
            F.col("_p.base").alias("base_currency"),
            F.explode("_p.rates").alias("_date", "_quotes"),
        )
        .select("*", F.explode("_quotes").alias("quote_currency", "rate"))
    )
    return _rate_rows(rows, run_id, ingested_at)
