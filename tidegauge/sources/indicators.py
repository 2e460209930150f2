"""Landed macro-indicator pages to observation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.sources.payloads import read_pages
from tidegauge.sources.schemas import MACRO_META_JSON, MACRO_ROW_JSON, columns_of

# Fixed value: the source recorded with every observation.
SOURCE_URI = "https://api.worldbank.org/v2/country/all/indicator"

def _present(value: Column) -> Column:
    """Blank counts as missing."""
    return F.nullif(value, F.lit(""))


def parse_macro_pages(pages: DataFrame, text: str = "payload", on_bad: str = "raise") -> DataFrame:
    """All rows of all pages, each with its raw JSON.

    The country is the three-letter code, else the id; the indicator is the name,
    else the id. Rows that are no JSON objects are skipped. A page of another shape
    fails the parse, or is left out with ``on_bad="skip"``.
    """
    others = [c for c in pages.columns if c != text]
    raw_rows = F.from_json(F.element_at("_parts", 2), "array<string>")
    row = F.from_json("raw_payload", MACRO_ROW_JSON)
    return (
        read_pages(pages, text, on_bad)
        .select(*others, F.explode(raw_rows).alias("raw_payload"))
        .filter(F.startswith(F.ltrim("raw_payload"), F.lit("{")))
        .withColumn("_row", row)
        .select(
            *others,
            F.coalesce(_present(F.col("_row.countryiso3code")), _present(F.col("_row.country.id"))).alias(
                "country_code"
            ),
            F.coalesce(
                _present(F.col("_row.indicator.value")), _present(F.col("_row.indicator.id"))
            ).alias("indicator_name"),
            _present(F.col("_row.date")).alias("observation_date"),
            F.col("_row.value").try_cast("double").alias("observation_value"),
            "raw_payload",
        )
    )


def standardize_indicators(
    rows: DataFrame, source: str | Column = SOURCE_URI, ingested_at: Column | None = None
) -> DataFrame:
    """Parsed rows with their ingestion columns (those of ``macro_indicators_raw``)."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return rows.withColumns(
        {
            "ingest_ts": stamp,
            "_ingest_date": F.to_date(stamp),
            "_source": F.lit(source) if isinstance(source, str) else source,
        }
    ).select(*columns_of("macro_indicators_raw"))


def page_counts(pages: DataFrame, text: str = "payload", on_bad: str = "raise") -> DataFrame:
    """The page count every page announces; 1 when its metadata has none."""
    others = [c for c in pages.columns if c != text]
    meta = F.from_json(F.element_at("_parts", 1), MACRO_META_JSON)
    return read_pages(pages, text, on_bad).filter("_parts is not null").select(
        *others, F.coalesce(meta["pages"], F.lit(1)).alias("page_count")
    )
