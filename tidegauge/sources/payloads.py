"""Broken payloads: told apart from valid ones that hold no data.

A parser reads a payload once, together with what is wrong with it. By default it
fails on the first broken payload, as the feeds' own clients do; with
``on_bad="skip"`` it leaves them out, and :func:`rejected` lists them with the
reason, for a table of rejects and the count in the audit row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.sources.schemas import (
    CANDLES_JSON,
    FX_LATEST_JSON,
    FX_RANGE_JSON,
    PRICE_HISTORY_CSV,
    PRICE_SNAPSHOT_CSV,
    QUOTE_JSON,
)

NOT_JSON = "not the JSON object expected"
NOT_CSV = "not the CSV header expected"
NOT_PAGE = "Macro page is not a JSON array of metadata and rows."
# Fixed value: what the CSV feed answers where it has no rows.
NO_DATA = "No data"
UNEVEN = "prices and times differ in number"
NO_DATE = "a date that is none"


def _object(text: str | Column, schema: str) -> Column:
    """The payload as a struct; ``_bad`` holds the text if it is another shape."""
    return F.from_json(text, f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})


def _is_day(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull()


def _reason(parsed: Column, *others: tuple[Column, str]) -> Column:
    reason = F.when(parsed.isNull() | parsed["_bad"].isNotNull(), NOT_JSON)
    for condition, text in others:
        reason = reason.when(condition, text)
    return reason


def _candles(p: Column) -> Column:
    sizes = [F.coalesce(F.size(p[name]), F.lit(0)) for name in ("c", "t")]
    return _reason(p, ((p["s"] == "ok") & (sizes[0] != sizes[1]), UNEVEN))


def _fx_latest(p: Column) -> Column:
    held = F.coalesce(F.size(p["rates"]), F.lit(0)) > 0
    return _reason(p, (held & ~F.coalesce(_is_day(p["date"]), F.lit(False)), NO_DATE))


def _fx_range(p: Column) -> Column:
    return _reason(p, (F.exists(F.map_keys(p["rates"]), lambda day: ~_is_day(day)), NO_DATE))


# Feed -> layout and the test of a parsed payload.
FEEDS = {
    "candles": (CANDLES_JSON, _candles),
    "quotes": (QUOTE_JSON, _reason),
    "fx_latest": (FX_LATEST_JSON, _fx_latest),
    "fx_range": (FX_RANGE_JSON, _fx_range),
}


# Feed -> columns of its CSV texts.
CSV_FEEDS = {"price_csv": PRICE_SNAPSHOT_CSV, "price_history_csv": PRICE_HISTORY_CSV}
MACRO_FEED = "macro_pages"
ALL_FEEDS = (*FEEDS, *CSV_FEEDS, MACRO_FEED)


def _checked_mode(on_bad: str) -> str:
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad is raise or skip, not {on_bad}")
    return on_bad


def _refused(feed: str, reason: Column, text: str | Column, kind: str, on_bad: str) -> Column:
    """In place of a broken payload: a failure that says why, or nothing."""
    if _checked_mode(on_bad) == "skip":
        return F.lit(None).cast(kind)
    shown = F.coalesce(F.substring(F.col(text) if isinstance(text, str) else text, 1, 80), F.lit("null"))
    return F.raise_error(F.concat(F.lit(f"{feed}: "), reason, F.lit(": "), shown)).cast(kind)


def read(payloads: DataFrame, feed: str, text: str, on_bad: str) -> DataFrame:
    """The payloads with ``_p``, the parsed struct, null where it is skipped."""
    schema, test = FEEDS[feed]
    # Generators, so that the text is parsed once however many columns are read.
    parsed = payloads.select("*", F.explode(F.array(_object(text, schema))).alias("_raw"))
    raw = F.col("_raw")
    reason = test(raw)
    kind = parsed.schema["_raw"].dataType.simpleString()
    checked = F.when(reason.isNotNull(), _refused(feed, reason, text, kind, on_bad)).otherwise(raw)
    return parsed.select(*payloads.columns, F.explode(F.array(checked)).alias("_p"))


def csv_lines(text: str | Column) -> Column:
    """The lines of a CSV text that are not blank."""
    lines = F.split(F.translate(text, "\r", "\n"), "\n")
    return F.filter(lines, lambda line: F.trim(line) != "")


def _csv_reason(lines: Column, schema: str) -> Column:
    """The first line must name the columns; a text without lines, or that says so, has
    no data."""
    names = ",".join(column.split()[0] for column in schema.split(", "))
    header = F.lower(F.regexp_replace(F.get(lines, F.lit(0)), r"[\s\x{FEFF}\"]", ""))
    known = header.isin(names.lower(), NO_DATA.lower().replace(" ", ""))
    return F.when(lines.isNull() | (F.size(lines) > 0) & ~known, F.lit(NOT_CSV))


def read_csv(payloads: DataFrame, feed: str, schema: str, text: str, on_bad: str) -> DataFrame:
    """The payloads with ``_lines``, header first, null where a text is skipped."""
    listed = payloads.select("*", F.explode(F.array(csv_lines(text))).alias("_all"))
    lines = F.col("_all")
    reason = _csv_reason(lines, schema)
    refused = _refused(feed, reason, text, "array<string>", on_bad)
    return listed.withColumn("_lines", F.when(reason.isNotNull(), refused).otherwise(lines)).drop("_all")


def _page_reason(parts: Column) -> Column:
    def absent_or(part: Column, mark: str) -> Column:
        return part.isNull() | (part == "null") | F.startswith(F.ltrim(part), F.lit(mark))

    meta, rows = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    # A page without rows may have null instead of an empty list.
    whole = (F.size(parts) >= 2) & absent_or(meta, "{") & absent_or(rows, "[")
    return F.when(~F.coalesce(whole, F.lit(False)), F.lit(NOT_PAGE))


def read_pages(pages: DataFrame, text: str, on_bad: str) -> DataFrame:
    """The pages with ``_parts``, metadata and rows as JSON texts, null where skipped."""
    others = [c for c in pages.columns if c != text]
    split = pages.select(*others, F.col(text).alias("_text"), F.from_json(text, "array<string>").alias("_array"))
    reason = _page_reason(F.col("_array"))
    refused = _refused(MACRO_FEED, reason, "_text", "array<string>", on_bad)
    return split.select(*others, F.when(reason.isNotNull(), refused).otherwise(F.col("_array")).alias("_parts"))


def rejected(payloads: DataFrame, feed: str, text: str = "payload") -> DataFrame:
    """The broken payloads with all their columns and the ``reason``."""
    if feed in CSV_FEEDS:
        reason = _csv_reason(csv_lines(text), CSV_FEEDS[feed])
        return payloads.select("*", reason.alias("reason")).filter("reason is not null")
    if feed == MACRO_FEED:
        reason = _page_reason(F.from_json(text, "array<string>"))
        return payloads.select("*", reason.alias("reason")).filter("reason is not null")
    schema, test = FEEDS[feed]
    parsed = payloads.select("*", F.explode(F.array(_object(text, schema))).alias("_raw"))
    return parsed.select(*payloads.columns, test(F.col("_raw")).alias("reason")).filter("reason is not null")
