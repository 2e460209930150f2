"""Every registered query against its SQL, and the plans that must hold at scale."""

from __future__ import annotations

import json

import duckdb
import pytest

import __spark_entry__
from tidegauge.plans import briefing
from tidegauge.sinks.audit import log_run
from tidegauge.sinks.tables import bootstrap
from tidegauge.sources.tables import scan
from workload.lake import Lake
from workload.oracle import all_sql
from workload.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def sql_engine(sf_dir):
    engine = duckdb.connect()
    for name in TABLES:
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return engine


def ordered(data):
    return sorted(data, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_reference_query_has_sql():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, sf_dir, sql_engine, name):
    df = QUERIES[name](spark, sf_dir)
    result = sql_engine.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    places = [names.index(c) for c in df.columns]
    expected = ordered(tuple(row[i] for i in places) for row in result.fetchall())
    got = ordered(tuple(row) for row in df.collect())
    assert got == expected
    assert [[type(v) for v in r] for r in got] == [[type(v) for v in r] for r in expected]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_briefing_json_holds_its_sections(spark, sf_dir):
    whole = briefing.briefing_json(Lake(spark, sf_dir), include_heavy=True)
    payload = json.loads(whole.first()["payload"])
    assert set(payload) == {*briefing.SECTIONS, "heavy"}
    assert set(payload["heavy"]) == set(briefing.HEAVY_SECTIONS)
    gold = Lake(spark, sf_dir)

    def plain(section):
        return json.loads(json.dumps([r.asDict() for r in section(gold).collect()], default=str))

    for name, section in briefing.SECTIONS.items():
        expected = plain(section)
        assert payload[name] == (expected[0] if name == "latest_dates" else expected)
    for name, section in briefing.HEAVY_SECTIONS.items():
        assert payload["heavy"][name] == plain(section)


def test_briefing_json_of_empty_gold(spark, sf_dir):
    gold = {name: df.limit(0) for name, df in Lake(spark, sf_dir).items()}
    payload = json.loads(briefing.briefing_json(gold).first()["payload"])
    assert payload["regime"] == [] and payload["latest_dates"]["fx_rate_date"] is None


def _plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_fx_windows_run_once(spark, sf_dir):
    plan = _plan(Lake(spark, sf_dir)["fx_trend_signals"])
    assert plan.count("stddev_samp") > 0 and "Union" not in plan
    assert sum("stddev_samp" in line and "+- Window" in line for line in plan.splitlines()) <= 1


def test_summary_reads_each_domain_once_without_nested_loops(spark, sf_dir):
    plan = _plan(Lake(spark, sf_dir)["cross_signal_summary"])
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert plan.count("l_extendedprice") > 0 and plan.count("lineitem.parquet") == 1


def test_reports_read_the_newest_month_only(spark, sf_dir):
    for name in ("dashboard_kpis", "briefing_market_breadth"):
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        assert "PartitionFilters: [isnotnull(_month" in df._jdf.queryExecution().executedPlan().toString()


def test_queries_leave_the_sessions_tables_alone(spark, sf_dir):
    bootstrap(spark)
    log_run(spark, "somebody else's job", "SUCCESS", 1)
    for name in ("managed_runs", "managed_rates", "dashboard_kpis"):
        assert QUERIES[name](spark, sf_dir).count() > 0
    assert scan(spark, "pipeline_runs").filter("pipeline_name LIKE 'somebody%'").count() == 1
