"""Updates by what changed equal full rebuilds, and read only what they must."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidegauge.plans import briefing, checks, dashboards, incremental, jobs, measures, report_states
from tidegauge.sinks import versions
from tidegauge.sinks.tables import bootstrap
from tidegauge.sinks.versions import current_version, months_moved, read_version
from tidegauge.sources.tables import Catalog, scan
from workload.lake import BUILDERS, RAW
from workload.managed import DELAYED, STAMPS, late

GOLD = list(jobs.GOLD)


# Some months of the data, with gaps, so that the tables have few partitions.
MONTHS = ["1995-02", "1995-03", "1995-04", "1995-06", "1997-10", "1997-11", "1997-12", "2000-01"]
MONTHS += [f"2001-{m:02}" for m in range(1, 12)]


@pytest.fixture(scope="module")
def raws(spark, sf_dir):
    def some(table):
        raw = RAW[table](spark, sf_dir)
        text = F.date_format(STAMPS[table], "yyyy-MM") if table in STAMPS else F.substring("observation_date", 1, 7)
        # What is no date stays, to be refused on the way.
        return raw.filter(text.isin(MONTHS) | text.isNull() | ~text.contains("-"))

    return {table: some(table) for table in RAW}


@pytest.fixture(scope="module")
def parts(raws):
    """Raw rows that come on time, and those that come late, corrected or twice."""
    return {table: late(raw, table) for table, raw in raws.items()}


@pytest.fixture(scope="module")
def built(spark, parts):
    prefix = f"inc{uuid.uuid4().hex[:8]}_"
    bootstrap(spark, prefix)
    for table, (first, _) in parts.items():
        jobs.ingest(first, table, load_id="first", prefix=prefix)
    incremental.full_build(spark, prefix)
    before = {t: current_version(spark, t, prefix) for t in (*jobs.SILVER, *GOLD)}
    for table, (_, second) in parts.items():
        jobs.ingest(second, table, load_id="second", prefix=prefix)
    written = incremental.update(spark, prefix)
    return prefix, before, written


def test_update_equals_full_rebuild(spark, raws, built):
    prefix, _, _ = built
    whole = dict(raws)
    for table, (inputs, build) in BUILDERS.items():
        whole[table] = build(*[whole[name] for name in inputs])
    for table in (*jobs.SILVER, *GOLD):
        assert rows(scan(spark, table, prefix)) == rows(whole[table]), table


def test_untouched_months_keep_their_files(spark, built):
    prefix, before, written = built
    for table in ("daily_market_snapshot", "macro_indicator_trends"):
        assert months_moved(spark, table, before[table], current_version(spark, table, prefix), prefix) == written[table]
    for domain in incremental.DOMAINS:
        all_months = {r[0] for r in read_version(spark, domain.silver, current_version(spark, domain.silver, prefix), prefix).select("_month").distinct().collect()}
        moved = months_moved(spark, domain.silver, before[domain.silver], current_version(spark, domain.silver, prefix), prefix)
        assert set(moved) < all_months and set(moved) <= set(DELAYED)
    # The reach of a change ends; the months of a gap behind it stay as they are.
    assert set(written["fx_trend_signals"]) < set(MONTHS)


def test_reports_from_states_equal_those_over_the_tables(spark, built):
    prefix, _, _ = built
    tables = Catalog(spark, prefix)
    over_tables = {f"briefing_{name}": build for name, build in briefing.HEAVY_SECTIONS.items()} | {
        "report_risk_return_by_symbol": lambda t: measures.report_avgs(t)["risk_return_by_symbol"],
        "report_yoy_by_indicator_and_trend": lambda t: measures.report_avgs(t)["yoy_by_indicator_and_trend"],
        "report_stressed_pairs_card": lambda t: measures.report_avgs(t)["stressed_pairs_card"],
        "measure_stress_count": lambda t: measures.stress_count(t["daily_market_snapshot"], "symbol"),
        "demo_layer_counts": dashboards.layer_counts,
        "demo_freshness": dashboards.freshness,
        "demo_history_depth": dashboards.history_depth,
    }
    assert set(over_tables) == set(report_states.REPORTS)
    for name, build in over_tables.items():
        expected, got = build(tables), report_states.REPORTS[name](tables)
        assert rows(got, *expected.columns) == rows(expected), name
    checked = checks.run_checks({t: tables[t] for t in tables if t != "pipeline_runs"}, "2002-01-01")
    assert rows(report_states.run_checks(tables, "2002-01-01")) == rows(checked)
    jobs_states = [rows(briefing.briefing_json(tables, True, heavy)) for heavy in (briefing.HEAVY_SECTIONS, report_states.HEAVY_SECTIONS)]
    assert jobs_states[0] == jobs_states[1]


def test_reports_from_states_read_no_daily_row(spark, built):
    prefix, _, _ = built
    tables = Catalog(spark, prefix)
    dated = {"demo_freshness", "demo_layer_counts"}  # these read the summary, a row per date
    for name, build in report_states.REPORTS.items():
        files = build(tables).inputFiles()
        allowed = "_months-" if name not in dated else ("_months-", "/cross_signal_summary-", "/load_ledger-")
        read = {f.split("/_month=")[0].rsplit("/", 1)[-1] if "/_month=" in f else f for f in files}
        kinds = (allowed,) if isinstance(allowed, str) else allowed
        assert files and all(any(k.strip("/") in f for k in kinds) for f in read), (name, read)


def test_states_of_untouched_months_keep_their_files(spark, built):
    prefix, before, written = built
    for state, (table, _) in report_states.BUILDERS.items():
        now = current_version(spark, state, prefix)
        moved = months_moved(spark, table, before[table], current_version(spark, table, prefix), prefix)
        assert months_moved(spark, state, now - 1, now, prefix) == moved, state


def test_nothing_new_writes_nothing(spark, built):
    prefix, _, _ = built
    now = {t: current_version(spark, t, prefix) for t in (*jobs.SILVER, "daily_market_snapshot")}
    assert incremental.update(spark, prefix) == {d.gold: [] for d in incremental.DOMAINS}
    assert {t: current_version(spark, t, prefix) for t in now} == now


def test_a_lost_update_is_made_good(spark, raws, monkeypatch):
    prefix = f"inc{uuid.uuid4().hex[:8]}_"
    bootstrap(spark, prefix)
    raw = raws["macro_indicators_raw"]
    early = F.col("observation_date") < "1997"
    jobs.ingest(raw.filter(early | ~F.col("observation_date").contains("-")), "macro_indicators_raw", prefix=prefix)
    for table in ("market_prices_raw", "fx_rates_raw"):
        few = F.date_format(STAMPS[table], "yyyy-MM") == "2001-07"
        jobs.ingest(raws[table].filter(few), table, prefix=prefix)
    incremental.full_build(spark, prefix)
    jobs.ingest(raw.filter(~early), "macro_indicators_raw", prefix=prefix)
    replace = versions.replace

    def fail_at(table):
        def once(df, name, *args, **kwargs):
            if name == table:
                raise RuntimeError("driver lost")
            return replace(df, name, *args, **kwargs)

        return once

    # Lost once behind Silver, once behind Gold, once behind the states.
    for table in ("macro_indicator_trends", "macro_changes", "cross_signal_summary"):
        monkeypatch.setattr(incremental, "replace", fail_at(table))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.update(spark, prefix)
    monkeypatch.undo()
    incremental.update(spark, prefix)
    found = {t: rows(scan(spark, t, prefix)) for t in GOLD}
    incremental.full_build(spark, prefix)
    for table in GOLD:
        assert found[table] == rows(scan(spark, table, prefix)), table
