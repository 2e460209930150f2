"""What one task takes: pieces of a scan, rows of a file, look-ups of a window."""

from __future__ import annotations

import uuid

import pytest

from helpers import price_rows, rows
from tidegauge.plans import jobs
from tidegauge.plans.market import market_snapshot
from tidegauge.plans.silver import clean_market
from tidegauge.session import PARTS_KEY, SHUFFLE_PARTS, TASK_BYTES, configure
from tidegauge.sinks import tables, versions
from tidegauge.sinks.loads import load
from tidegauge.sinks.tables import bootstrap, loads_of
from tidegauge.sinks.versions import current_version, read_version
from tidegauge.sources.schemas import TABLES

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(price_rows("A", [100.0 + i for i in range(35)]), TABLES["market_prices_raw"][1])


@pytest.mark.parametrize("key", TASK_BYTES)
def test_larger_pieces_are_cut_and_smaller_ones_stay(spark, key):
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1g")
        configure(spark)
        assert spark.conf.get(key) == f"{TASK_BYTES[key]}b"
        spark.conf.set(key, "1m")
        configure(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_files_hold_few_rows_and_months_are_not_sorted_anew(spark, raw, monkeypatch):
    most, prefix = 10, f"sizes_{uuid.uuid4().hex[:8]}_"
    monkeypatch.setattr(tables, "FILE_ROWS", most)
    monkeypatch.setattr(versions, "FILE_ROWS", most)
    bootstrap(spark, prefix)
    before, seen = spark.conf.get(WRITERS), []
    load(raw.coalesce(1), "market_prices_raw", "first", prefix)
    with tables.side_by_side(spark):
        seen.append(spark.conf.get(WRITERS))
    jobs.rebuild(spark, "silver", {"market_prices": jobs.SILVER["market_prices"]}, prefix)
    written = read_version(spark, "market_prices", current_version(spark, "market_prices", prefix), prefix)
    for table in (spark.read.table(loads_of("market_prices_raw", prefix)), written):
        counts = table.groupBy("_metadata.file_path").count()
        assert counts.agg({"count": "sum"}).first()[0] == 35
        assert counts.agg({"count": "max"}).first()[0] <= most
    assert rows(written.drop("_month")) == rows(clean_market(raw))
    assert seen == [str(tables.OPEN_FILES)] and spark.conf.get(WRITERS) == before


def test_each_look_up_of_the_snapshot_runs_once(spark, raw):
    plan = market_snapshot(clean_market(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lag(latest_price") == 4
    assert plan.count("lag(_block_high") == 9


def test_shuffles_are_cut_finer_than_the_cores(spark):
    """Parts are then joined up to a size, so a part does not grow with the input."""
    before = spark.conf.get(PARTS_KEY, None)
    try:
        for given, held in (("8", SHUFFLE_PARTS), (str(2 * SHUFFLE_PARTS), 2 * SHUFFLE_PARTS)):
            spark.conf.set(PARTS_KEY, given)
            configure(spark)
            assert spark.conf.get(PARTS_KEY) == str(held)
        spark.conf.unset(PARTS_KEY)
        configure(spark)
        assert spark.conf.get(PARTS_KEY) == str(SHUFFLE_PARTS)
    finally:
        spark.conf.unset(PARTS_KEY) if before is None else spark.conf.set(PARTS_KEY, before)
