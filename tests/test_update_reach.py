"""What an update reads and writes of a series, and what a load costs a row."""

from __future__ import annotations

import uuid
from decimal import Decimal

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import price_rows
from tidegauge.plans import incremental
from tidegauge.sinks.loads import _content, _content_of, booked, load
from tidegauge.sinks.tables import bootstrap, loads_of
from tidegauge.sources.schemas import TABLES, columns_of

MONTHS = [f"20{y:02d}-{m:02d}" for y in range(4) for m in range(1, 13)]
REACH = 5


def expected(counts: dict[str, int], changed: set[str]) -> tuple[list[str], list[str]]:
    """Row by row: a row is written if its month has a change or one lies at most REACH
    rows ahead of it, whatever rows the month has; whole months go together."""
    places = [month for month in sorted(counts) for _ in range(counts[month])]
    months = sorted(counts)
    written = {
        m for m in months
        if m in changed or any(places[: places.index(m)][-REACH:].count(c) for c in changed if c < m)
    }
    read = set(written)
    for m in written:
        read |= set(places[max(0, places.index(m) - REACH) : places.index(m)])
    return sorted(read), sorted(written)


def test_months_between_changes_that_neither_reaches_are_left_out(spark):
    counts = {
        "A": dict.fromkeys(MONTHS, 2),
        "B": {m: 1 + i % 4 for i, m in enumerate(MONTHS) if i % 5},
        "C": dict.fromkeys(MONTHS[:3], 1),
        "D": dict.fromkeys(MONTHS, 1),
    }
    changed = {"A": {MONTHS[4], MONTHS[30]}, "B": {MONTHS[1], MONTHS[22], MONTHS[23], MONTHS[46]}, "C": {MONTHS[2]}}
    state = spark.createDataFrame(
        [(s, m, n) for s, of in counts.items() for m, n in of.items()], "symbol string, month string, observations bigint"
    )
    rows = spark.createDataFrame([(s, m) for s, of in changed.items() for m in of for _ in range(3)], "symbol string, _month string")
    found = incremental.reached_months(incremental.MARKET, state, rows, REACH).collect()
    assert {r["of_symbol"]: (sorted(r["read"]), sorted(r["written"])) for r in found} == {
        s: expected(counts[s], changed[s]) for s in changed
    }
    read = next(r["read"] for r in found if r["of_symbol"] == "A")
    assert MONTHS[15] not in read and len(read) < 20


def test_days_of_a_month_are_counted_in_one_pass(spark):
    silver = spark.createDataFrame(
        price_rows("A", [1.0] * 40) + price_rows("A", [2.0] * 3) + price_rows("B", [1.0]), TABLES["market_prices_raw"][1]
    )
    counted = incremental.series_months(incremental.MARKET, silver)
    assert sorted(tuple(r) for r in counted.collect()) == [("A", "2024-01", 31), ("A", "2024-02", 9), ("B", "2024-01", 1)]
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_content_is_the_sum_of_hashes_without_decimals_and_stamps_have_64_bits(spark):
    rows = spark.createDataFrame(price_rows("A", [100.0 + i for i in range(50)]), TABLES["market_prices_raw"][1])
    hashes = [r[0] for r in rows.select(F.xxhash64(*columns_of("market_prices_raw"))).collect()]
    assert min(hashes) < 0 < max(hashes)
    parts = rows.agg(*_content("market_prices_raw"))
    assert all(kind == "bigint" for _, kind in parts.dtypes)
    assert _content_of(parts.first()) == Decimal(sum(hashes))
    assert _content_of(rows.limit(0).agg(*_content("market_prices_raw")).first()) == 0
    prefix = f"reach_{uuid.uuid4().hex[:8]}_"
    bootstrap(spark, prefix)
    load(rows, "market_prices_raw", "first", prefix)
    assert booked(spark, "market_prices_raw", prefix).first()["content"] == Decimal(sum(hashes))
    assert load(rows, "market_prices_raw", "first", prefix).repeated
    (file, *_) = spark.read.table(loads_of("market_prices_raw", prefix)).inputFiles()
    stamp = pq.ParquetFile(file.removeprefix("file:")).schema.column(columns_of("market_prices_raw").index("market_time"))
    assert stamp.physical_type == "INT64"
