"""What the daily jobs hold on disk: shuffle files, bytes that go through shuffles, pages."""

from __future__ import annotations

import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import price_rows, rows
from tidegauge.plans import incremental, jobs, market
from tidegauge.plans.market import market_snapshot
from tidegauge.plans.silver import clean_market
from tidegauge.sinks import versions
from tidegauge.sinks.loads import load
from tidegauge.sinks.tables import bootstrap, shuffles_freed
from tidegauge.sinks.versions import current_version, read_version
from tidegauge.sources.schemas import TABLES
from tidegauge.sources.tables import scan

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MARKET = {"market_prices": jobs.SILVER["market_prices"]}
SNAPSHOT = {"daily_market_snapshot": jobs.GOLD["daily_market_snapshot"]}


def prices(spark, data):
    return spark.createDataFrame(data, TABLES["market_prices_raw"][1])


@pytest.fixture
def prefix(spark):
    name = f"disk_{uuid.uuid4().hex[:8]}_"
    bootstrap(spark, name)
    return name


def shuffle_files(spark) -> set[Path]:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {path for folder in folders for path in Path(folder.toString()).rglob("shuffle_*")}


def test_writes_leave_no_shuffle_files(spark, prefix):
    before, setting = shuffle_files(spark), spark.conf.get(FREED)
    load(prices(spark, price_rows("A", [100.0 + i for i in range(200)])), "market_prices_raw", "first", prefix)
    jobs.rebuild(spark, "silver", MARKET, prefix)
    jobs.rebuild(spark, "gold", SNAPSHOT, prefix)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREED) == setting
    with shuffles_freed(spark):
        assert spark.conf.get(FREED) == "true"


def test_pages_are_packed_by_zstd(spark, prefix):
    load(prices(spark, price_rows("A", [100.0] * 40)), "market_prices_raw", "first", prefix)
    jobs.rebuild(spark, "silver", MARKET, prefix)
    for file in read_version(spark, "market_prices", current_version(spark, "market_prices", prefix), prefix).inputFiles():
        assert pq.ParquetFile(file.removeprefix("file:")).metadata.row_group(0).column(0).compression == "ZSTD"


def written_plan(spark, prefix, monkeypatch, run) -> str:
    plans = []

    def seen(df, table, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return versions.replace(df, table, *args, **kwargs)

    monkeypatch.setattr(jobs, "replace", seen)
    run()
    monkeypatch.undo()
    return plans[-1]


def test_gold_is_dealt_by_symbol_once_and_by_month_as_closes(spark, prefix, monkeypatch):
    load(prices(spark, price_rows("A", [100.0 + i for i in range(60)])), "market_prices_raw", "first", prefix)
    jobs.rebuild(spark, "silver", MARKET, prefix)
    plan = written_plan(spark, prefix, monkeypatch, lambda: jobs.rebuild(spark, "gold", SNAPSHOT, prefix))
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(shuffles) == 2 and "REBALANCE" in shuffles[0] and "hashpartitioning(symbol" in shuffles[1]
    # What follows from a row alone is found behind the last shuffle.
    behind = plan[plan.index(shuffles[0]) :]
    assert "stress_flag" not in behind and "return_30d_pct" not in behind
    silver = scan(spark, "market_prices", prefix)
    assert rows(scan(spark, "daily_market_snapshot", prefix)) == rows(market_snapshot(silver))


@pytest.mark.parametrize("most", [10, 60, 1000])
def test_crowded_symbols_bring_the_last_row_of_a_day(spark, monkeypatch, most):
    monkeypatch.setattr(market, "CROWDED_ROWS", most)
    days = price_rows("A", [100.0 + i for i in range(12)]) + price_rows("B", [50.0 - i for i in range(5)])
    ticks = prices(spark, days).withColumn("minute", F.explode(F.sequence(F.lit(0), F.lit(6))))
    stamp = F.timestamp_seconds(F.unix_seconds("market_time") + 60 * F.col("minute"))
    raw = ticks.withColumn("market_time", stamp).withColumn("price", F.col("price") + F.col("minute") / 100).drop("minute")
    silver = clean_market(raw)
    dealt = market.by_symbol(silver)
    crowded = {10: 17, 60: 12 + 35, 1000: 7 * 17}
    assert dealt.count() == crowded[most]
    assert rows(market_snapshot(dealt)) == rows(market_snapshot(silver))


def test_months_that_changes_reach_for_most_series_are_built_whole(spark, prefix, monkeypatch):
    months = 150
    series = {name: [100.0 + n + i % 7 for i in range(months)] for n, name in enumerate("ABCDE")}
    all_rows = [row for name, closes in series.items() for row in price_rows(name, closes)]
    late = [r for r in all_rows if r[0] in "ABC" and 130 <= r[3].toordinal() - all_rows[0][3].toordinal() < 133]
    late += [r for r in all_rows if r[0] == "D" and r[3].toordinal() - all_rows[0][3].toordinal() == 20]
    load(prices(spark, [r for r in all_rows if r not in late]), "market_prices_raw", "first", prefix)
    jobs.rebuild(spark, "silver", MARKET, prefix)
    jobs.rebuild(spark, "gold", SNAPSHOT, prefix)
    load(prices(spark, late), "market_prices_raw", "second", prefix)
    incremental.update_silver(spark, incremental.MARKET, prefix)
    # States of the whole table, as a full build leaves them.
    state = incremental.series_months(incremental.MARKET, scan(spark, "market_prices", prefix))
    versions.replace(state, "market_series_months", prefix=prefix)
    asked = []
    of_months = incremental._of_months

    def seen(df, reached, domain, kind, how="left_semi"):
        if how == "left_anti":
            asked.extend(sorted(r[0] for r in df.select("_month").distinct().collect()))
        return of_months(df, reached, domain, kind, how)

    monkeypatch.setattr(incremental, "_of_months", seen)
    written = incremental.update_gold(spark, incremental.MARKET, prefix)
    monkeypatch.undo()
    assert written == ["2024-01", "2024-02", "2024-03", "2024-04", "2024-05"]
    # Only D is reached from January to April; in May three of five are.
    assert asked == ["2024-01", "2024-02", "2024-03", "2024-04"]
    silver = scan(spark, "market_prices", prefix)
    assert rows(scan(spark, "daily_market_snapshot", prefix)) == rows(market_snapshot(silver))
