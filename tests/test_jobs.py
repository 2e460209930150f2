"""The daily jobs on managed tables: ingest, rebuild, validate, export, audit."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidegauge.operators.latest import latest_rows
from tidegauge.plans import briefing, jobs
from tidegauge.sinks import audit, export
from tidegauge.sinks.loads import LoadConflict, book, load
from tidegauge.sinks.tables import NoData, bootstrap, loads_of
from tidegauge.sinks.versions import VersionConflict, collect_versions, current_version, read_version, replace
from tidegauge.sources import indicators, prices, rates
from tidegauge.sources.schemas import TABLES, columns_of, qualified
from tidegauge.sources.tables import Catalog, empty, scan
from workload import bindings
from workload.lake import RAW, Lake


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    bootstrap(spark)
    bootstrap(spark)
    for table, raw in RAW.items():
        jobs.ingest(raw(spark, sf_dir), table)
    jobs.rebuild_silver(spark)
    jobs.rebuild_gold(spark)
    return spark


def last_run(spark, name):
    runs = scan(spark, "pipeline_runs").filter(F.col("pipeline_name") == name)
    return runs.orderBy(F.col("run_timestamp").desc()).first()


def test_tables_follow_the_contract(lake):
    for table in TABLES:
        assert scan(lake, table).columns == columns_of(table)


def test_tables_equal_lazy_plans(lake, sf_dir):
    lazy = Lake(lake, sf_dir)
    for table in (*jobs.SILVER, *jobs.GOLD):
        assert rows(scan(lake, table)) == rows(lazy[table])


def test_newest_date_reads_one_month(lake, sf_dir):
    gold = Catalog(lake)
    for table, day in (("daily_market_snapshot", "snapshot_date"), ("fx_trend_signals", "rate_date")):
        newest = latest_rows(gold[table], day)
        assert rows(newest.select(*columns_of(table))) == rows(latest_rows(scan(lake, table), day))
        newest.collect()
        plan = newest._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_month" in plan
    assert rows(briefing.top_movers(gold)) == rows(briefing.top_movers(Lake(lake, sf_dir)))
    assert len(gold) == len(TABLES) == len(list(gold))


def test_raw_rows_lie_by_load_and_day(lake):
    raw = lake.read.table(loads_of("market_prices_raw"))
    part = raw.first()["_load"]
    one = raw.filter(F.col("_load") == part).filter("_ingest_date = '1998-01-02'")
    one.collect()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load" in plan and "EqualTo(_ingest_date,1998-01-02)" in plan


def test_runs_are_counted_while_written(lake):
    for layer, targets in (("silver", jobs.SILVER), ("gold", jobs.GOLD)):
        for table in targets:
            run = last_run(lake, f"{layer}_{table}")
            assert (run["status"], run["row_count"]) == ("SUCCESS", scan(lake, table).count())
    total = sum(scan(lake, table).count() for table in jobs.GOLD)
    assert last_run(lake, "gold_analytics")["row_count"] == total


def test_replayed_raw_rows_do_not_change_silver(lake, sf_dir):
    before = rows(scan(lake, "fx_rates"))
    copies = scan(lake, "fx_rates_raw").count()
    jobs.ingest(bindings.raw_rates(lake, sf_dir), "fx_rates_raw")
    assert scan(lake, "fx_rates_raw").count() == 2 * copies
    jobs.rebuild_silver(lake)
    assert rows(scan(lake, "fx_rates")) == before


def test_empty_load_needs_history(lake, spark):
    nothing = empty(spark, "macro_indicators_raw")
    assert jobs.ingest(nothing, "macro_indicators_raw", keep_history=True) == 0
    run = last_run(lake, "bronze_macro_indicators_raw")
    assert (run["status"], run["row_count"]) == ("SUCCESS", 0) and "history" in run["message"]
    with pytest.raises(NoData):
        jobs.ingest(nothing, "macro_indicators_raw")
    assert last_run(lake, "bronze_macro_indicators_raw")["status"] == "FAILED"


def test_validation(lake):
    # The last rate is of 2001-08-01.
    assert jobs.validate(lake, "2001-08-05") > 20
    assert last_run(lake, "validation_queries")["status"] == "SUCCESS"
    with pytest.raises(RuntimeError, match=r"freshness_days\(fx_rates\)"):
        jobs.validate(lake, "2010-01-01")
    assert last_run(lake, "validation_queries")["status"] == "FAILED"


def test_failing_job_is_audited_and_raised(lake):
    def fail():
        raise ValueError("no luck")

    with pytest.raises(ValueError):
        audit.audited(lake, "failing", fail)
    run = last_run(lake, "failing")
    assert (run["status"], run["row_count"], run["message"]) == ("FAILED", 0, "no luck")


def test_audit_failure_does_not_fail_the_job(lake, monkeypatch):
    def broken(*_):
        raise RuntimeError("audit is down")

    monkeypatch.setattr(audit, "append", broken)
    assert audit.audited(lake, "unlogged", lambda: 7) == 7
    with pytest.raises(RuntimeError):
        audit.log_run(lake, "unlogged", "SUCCESS", None)


def test_audit_takes_null_and_large_counts(lake):
    audit.log_run(lake, "counts", "SUCCESS", None)
    audit.log_run(lake, "counts", "SUCCESS", 5_000_000_000)
    runs = scan(lake, "pipeline_runs").filter("pipeline_name = 'counts'")
    assert rows(runs, "row_count") == [(5_000_000_000,), (None,)]


def test_export(lake, tmp_path):
    jobs.export_gold(lake, str(tmp_path), bindings.AS_OF)
    for table, date_column in export.EXPORTS.items():
        whole = lake.read.parquet(f"{tmp_path}/{table}")
        assert rows(whole) == rows(scan(lake, table))
        folder = Path(tmp_path, "dashboard", table)
        assert folder.exists() == bool(date_column)
        if date_column:
            lines = [line for f in folder.glob("*.json") for line in f.read_text().splitlines()]
            recent = scan(lake, table).filter(F.col(date_column) >= date(2000, 11, 10))
            assert len(lines) == recent.count()
            assert all(set(json.loads(line)) == set(columns_of(table)) for line in lines)


def test_failing_rebuild_keeps_the_table(lake):
    before = rows(scan(lake, "fx_rates"))
    boom = scan(lake, "fx_rates_raw").select(F.raise_error(F.lit("half way")).cast("string").alias("currency_pair"))
    with pytest.raises(Exception, match="half way"):
        replace(boom, "fx_rates")
    assert rows(scan(lake, "fx_rates")) == before


def test_failing_switch_keeps_the_table(lake, monkeypatch):
    before, calls = rows(scan(lake, "fx_rates")), []
    sql = type(lake).sql

    def once(self, text, *args, **kwargs):
        if text.startswith("ALTER VIEW silver.fx_rates ") and not calls:
            calls.append(text)
            raise RuntimeError("catalog is away")
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(lake), "sql", once)
    with pytest.raises(RuntimeError, match="away"):
        replace(scan(lake, "fx_rates_raw").selectExpr("base_currency AS currency_pair", "DATE'2020-01-01' AS rate_date"), "fx_rates")
    monkeypatch.undo()
    assert calls and rows(scan(lake, "fx_rates")) == before
    jobs.rebuild(lake, "silver", {"fx_rates": jobs.SILVER["fx_rates"]})
    assert rows(scan(lake, "fx_rates")) == before


@pytest.fixture
def small(spark):
    """Tables of their own under a prefix."""
    prefix = f"own{uuid.uuid4().hex[:8]}_"
    bootstrap(spark, prefix)
    return prefix


def rates_on(spark, *days_and_rates):
    data = [("A", "B", r, datetime(2024, 1 + m, d), "s", "u", datetime(2024, 6, 1), "run") for m, d, r in days_and_rates]
    return spark.createDataFrame(data, TABLES["fx_rates_raw"][1])


def test_a_prefix_touches_nothing_else(lake, spark, small):
    before = scan(lake, "pipeline_runs").count()
    assert jobs.ingest(rates_on(spark, (0, 1, 1.0)), "fx_rates_raw", prefix=small) == 1
    jobs.rebuild(spark, "silver", {"fx_rates": jobs.SILVER["fx_rates"]}, small)
    assert scan(spark, "fx_rates", small).count() == 1 and scan(spark, "pipeline_runs", small).count() == 2
    assert scan(lake, "pipeline_runs").count() == before


def test_readers_keep_their_version(spark, small):
    fx = {"fx_rates": jobs.SILVER["fx_rates"]}
    jobs.ingest(rates_on(spark, (0, 1, 1.0), (1, 1, 2.0)), "fx_rates_raw", prefix=small)
    jobs.rebuild(spark, "silver", fx, small)
    reader, first = scan(spark, "fx_rates", small).select("rate"), current_version(spark, "fx_rates", small)
    jobs.ingest(rates_on(spark, (1, 2, 3.0)), "fx_rates_raw", prefix=small)
    jobs.rebuild(spark, "silver", fx, small)
    assert (reader.count(), scan(spark, "fx_rates", small).count()) == (2, 3)
    # Kept as long as asked for, then gone, with the files that nobody else has.
    assert collect_versions(spark, "fx_rates", timedelta(hours=1), small) == []
    february = read_version(spark, "fx_rates", first + 1, small).filter("_month = '2024-02'").drop("_month")
    third = replace(february.limit(1), "fx_rates", months=["2024-02"], prefix=small)
    shared = read_version(spark, "fx_rates", third, small).filter("_month = '2024-01'").inputFiles()
    assert shared == read_version(spark, "fx_rates", first + 1, small).filter("_month = '2024-01'").inputFiles()
    assert first in collect_versions(spark, "fx_rates", timedelta(0), small)
    assert scan(spark, "fx_rates", small).count() == 2
    assert not Path(shared[0].removeprefix("file:")).parent.with_name("_month=2024-02").exists()
    with pytest.raises(Exception, match="NOT_FOUND|PATH|does not exist|FileNotFound"):
        reader.count()


def test_an_overtaken_writer_gives_up(spark, small, monkeypatch):
    from tidegauge.sinks import versions

    rows_now = jobs.SILVER["fx_rates"][1](rates_on(spark, (0, 1, 1.0)))
    publish = versions._publish

    def late(*args):
        monkeypatch.setattr(versions, "_publish", publish)
        replace(rows_now, "fx_rates", prefix=small)
        return publish(*args)

    monkeypatch.setattr(versions, "_publish", late)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS|was replaced"):
        replace(rows_now.limit(0), "fx_rates", prefix=small)
    assert scan(spark, "fx_rates", small).count() == 1
    assert issubclass(VersionConflict, RuntimeError)


def test_a_load_counts_once(spark, small, monkeypatch):
    from tidegauge.sinks import loads

    first = rates_on(spark, (0, 1, 1.0), (0, 2, 2.0))

    def crash(*_):
        raise RuntimeError("driver lost")

    # Lost between the rows and the ledger: nothing to be seen, and nothing twice later.
    monkeypatch.setattr(loads, "book", crash)
    with pytest.raises(RuntimeError, match="lost"):
        load(first, "fx_rates_raw", "day-1", small)
    monkeypatch.undo()
    assert scan(spark, "fx_rates_raw", small).count() == 0
    assert jobs.ingest(first, "fx_rates_raw", load_id="day-1", prefix=small) == 2
    # Lost after the ledger: the same load again adds nothing, in whatever order.
    assert jobs.ingest(first.orderBy("rate", ascending=False), "fx_rates_raw", load_id="day-1", prefix=small) == 0
    assert scan(spark, "fx_rates_raw", small).count() == 2
    assert "there already" in scan(spark, "pipeline_runs", small).filter("row_count = 0").first()["message"]
    with pytest.raises(LoadConflict):
        load(first.limit(1), "fx_rates_raw", "day-1", small)
    # Two runs at once: both write, both book, one is shown.
    lent = load(first, "fx_rates_raw", "day-2", small)
    part = spark.read.table(loads_of("fx_rates_raw", small)).filter("_load LIKE 'day-2%'").first()["_load"]
    copy = spark.read.table(loads_of("fx_rates_raw", small)).filter("_load LIKE 'day-2%'").withColumn("_load", F.lit("day-2.z"))
    copy.write.insertInto(loads_of("fx_rates_raw", small))
    book(spark, "fx_rates_raw", "day-2", "day-2.z", 2, 0, small)
    assert part < "day-2.z" and lent.rows == 2 and scan(spark, "fx_rates_raw", small).count() == 4


def test_landed_payloads_are_counted_and_backfilled(lake, spark):
    landed = spark.createDataFrame(
        [("q.us", '{"c":3.5,"t":1735689600}'), ("r.us", "<html>")], "symbol string, payload string"
    )
    assert jobs.ingest_landed(landed, "quotes", "market_prices_raw", prices.parse_quotes) == 1
    assert "1 payloads rejected" in last_run(lake, "bronze_market_prices_raw")["message"]
    requested = spark.createDataFrame([("q.us",), ("none.us",)], "symbol string")
    nothing = spark.createDataFrame([], "source_symbol string, Date string, Close double")
    quoted = prices.parse_quotes(landed, on_bad="skip")
    assert jobs.backfill(requested, nothing, quoted, "2024-01-01", "2025-01-01") == 1
    message = last_run(lake, "bronze_market_prices_raw")["message"]
    assert "1 empty, 1 snapshot_fallback" in message and "2024-01-01 to 2025-01-01" in message
    with pytest.raises(NoData, match=r"none.us=empty\[none.us:0,none:0\]"):
        jobs.backfill(requested.filter("symbol = 'none.us'"), nothing, quoted, "2024-01-01", "2025-01-01")


def test_json_values(spark, tmp_path):
    df = spark.createDataFrame(
        [
            (date(2024, 1, 1), float("nan"), None, datetime(2024, 1, 1, 3, 4, 5, 678901)),
            (date(2022, 1, 1), 1.0, "x", None),
        ],
        "d date, v double, s string, t timestamp",
    )
    export.export_json(df, str(tmp_path / "out"), "d", "2024-06-01")
    text = "".join(f.read_text() for f in Path(tmp_path, "out").glob("*.json"))
    assert json.loads(text) == {
        "d": "2024-01-01", "v": None, "s": None, "t": "2024-01-01 03:04:05.678901",
    }
    assert qualified("pipeline_runs") == "audit.pipeline_runs"


def test_payloads_reach_gold(lake, spark):
    """One payload per feed, from text to signals."""

    def landed(text, **columns):
        names = ", ".join(f"{n} string" for n in [*columns, "payload"])
        return spark.createDataFrame([(*columns.values(), text)], names)

    candles = json.dumps({"s": "ok", "c": [100.0, 97.0], "t": [1735689600, 1735776000]})
    latest = json.dumps({"base": "GBP", "date": "2025-01-02", "rates": {"USD": 1.25, "EUR": None}})
    row = {"country": {"id": "GB"}, "countryiso3code": "GBR", "indicator": {"id": "CPI"}, "date": "2024",
           "value": 3.2}
    page = json.dumps([{"pages": 1}, [row, row | {"date": "2025", "value": 3.0}]])
    jobs.ingest(prices.parse_candles(landed(candles, symbol="new.us")), "market_prices_raw")
    jobs.ingest(rates.parse_fx_latest(landed(latest, source_url="u"), "run"), "fx_rates_raw")
    macro = indicators.standardize_indicators(indicators.parse_macro_pages(landed(page)))
    assert jobs.ingest(macro, "macro_indicators_raw") == 2
    jobs.rebuild_silver(lake)
    jobs.rebuild_gold(lake)

    snapshot = scan(lake, "daily_market_snapshot").filter("symbol = 'NEW.US'")
    assert rows(snapshot, "snapshot_date", "day_change_pct", "stress_flag") == [
        (date(2025, 1, 1), None, False), (date(2025, 1, 2), -3.0, True)
    ]
    pair = scan(lake, "fx_trend_signals").filter("base_currency = 'GBP'")
    assert rows(pair, "currency_pair", "rate") == [("GBPUSD", 1.25)]
    trend = scan(lake, "macro_indicator_trends").filter("country_code = 'GBR'")
    assert rows(trend, "observation_date", "trend_direction") == [
        (date(2024, 1, 1), "flat"), (date(2025, 1, 1), "down")
    ]
    newest = scan(lake, "top_movers_why").first()
    assert newest["as_of_date"] == date(2025, 1, 2) and newest["symbol"] == "NEW.US"
