"""Rebuild of what changed only: from new loads to Silver, Gold and the summary.

For each domain:

1. The raw loads that the current Silver version does not hold are cleaned; Silver's
   months that they touch are merged with them by the same rule that cleans raw rows,
   so late, corrected and repeated rows need no rule of their own.
2. Gold's book names the Silver version that it was built from. Rows of the months
   written since that this version does not have are the changes. Per series their
   months, and the number of observations per month (a state table), say which months
   the windows reach: on from each change until as many observations as the longest
   look-back lie behind it, and back from there until as many lie ahead. Months
   between two changes that neither reaches are left out.
3. The domain's Gold builder runs over those months of those series; the months that
   a change reaches are written, with the other series' rows as they were. A month most
   of whose series are reached is built as a whole: to send Silver's rows through the
   windows takes fewer bytes than to look up which of Gold's far wider ones stay.
4. States of one row per date follow Gold in the same way: market and FX breadth for
   the months written; macro changes are differences between a row and the one before
   it, so those of the old rows are taken off and those of the new are added. The
   summary is put together from these states, and the movers from the newest month
   and the summary.
5. States of the reports and checks (:mod:`tidegauge.plans.report_states`) are built
   anew for the months of Silver and Gold that were written.

Months that nothing touches are neither read nor written: a new version of a table
points to the folders that they have. Every table names the version of its source, so
a job that is lost half-way is made good by the next. The result equals a full rebuild.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.operators.latest import latest_rows
from tidegauge.plans import report_states
from tidegauge.plans.cross import fx_breadth_by_date, macro_changes_by_date, market_breadth_by_date, summary_of
from tidegauge.plans.fx import fx_trends
from tidegauge.plans.jobs import rebuild_gold, rebuild_silver, rows_by_month
from tidegauge.plans.macro import macro_trends
from tidegauge.plans.market import market_snapshot
from tidegauge.plans.movers import movers_of_summary
from tidegauge.plans.silver import clean_fx, clean_macro, clean_market, merge_fx, merge_macro, merge_market
from tidegauge.sinks.audit import audited, write_counted
from tidegauge.sinks.loads import booked_parts, rows_of
from tidegauge.sinks.tables import gathered, shuffles_freed
from tidegauge.sinks.versions import current_version, loads_in, months_moved, read_version, replace, source_of
from tidegauge.sources.schemas import MONTH, MONTH_OF, columns_of
from tidegauge.sources.tables import Catalog, scan


@dataclass(frozen=True)
class Domain:
    raw: str
    silver: str
    gold: str
    months: str  # state: observations per series and month
    series: tuple[str, ...]
    clean: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    build: Callable[[DataFrame], DataFrame]
    reach: int  # observations that a change reaches
    observation: str  # what is counted once, of a series and month


# The longest look-back of each builder; macro changes compare a row with
# its predecessor, hence one more.
MARKET = Domain(
    "market_prices_raw", "market_prices", "daily_market_snapshot", "market_series_months", ("symbol",),
    clean_market, merge_market, market_snapshot, 90, "to_date(market_time)",
)
FX = Domain(
    "fx_rates_raw", "fx_rates", "fx_trend_signals", "fx_series_months", ("currency_pair",),
    clean_fx, merge_fx, fx_trends, 30, "rate_timestamp",
)
MACRO = Domain(
    "macro_indicators_raw", "macro_indicators", "macro_indicator_trends", "macro_series_months",
    ("country_code", "indicator_name"), clean_macro, merge_macro, macro_trends, 13, "observation_date",
)
DOMAINS = (MARKET, FX, MACRO)
BREADTH = {
    MARKET.gold: ("market_breadth", market_breadth_by_date),
    FX.gold: ("fx_breadth", fx_breadth_by_date),
}


def month_of(table: str) -> Column:
    return F.date_format(MONTH_OF[table], "yyyy-MM")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def _months(rows: DataFrame, column: str) -> list[str]:
    """Distinct months: no more than the calendar has."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def series_months(domain: Domain, silver: DataFrame) -> DataFrame:
    counted = silver.withColumn("month", month_of(domain.silver)).groupBy(*domain.series, "month")
    # A day's ticks are one close; rates and observations are rows of their own. Days of
    # a month are bits, which a hash aggregate counts in one pass.
    days = F.bit_count(report_states.days_of(F.expr(domain.observation))).cast("long")
    return counted.agg((days if domain is MARKET else F.count(F.lit(1))).alias("observations"))


def reaches(domain: Domain, counts: DataFrame, changed: DataFrame, reach: int) -> DataFrame:
    """Per changed series (its columns behind ``of_``): ``low``, the month that windows
    of ``reach`` observations start from, ``first``, that of the first change, and
    ``high``, the last month that a change reaches. ``changed`` has the month."""
    spans = changed.groupBy(*domain.series).agg(F.min(MONTH).alias("first"), F.max(MONTH).alias("last"))
    rows = counts.join(spans, list(domain.series))
    whole = Window.partitionBy(*domain.series)
    so_far = whole.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    n, month = F.col("observations"), F.col("month")
    placed = rows.select(
        *domain.series, "month", "first",
        F.sum(F.when(month < F.col("first"), n)).over(whole).alias("ahead"),
        F.sum(F.when(month <= F.col("last"), n)).over(whole).alias("through"),
        (month < F.col("first")).alias("before"), (month > F.col("last")).alias("after"),
        F.sum(n).over(so_far).alias("until"), n.alias("n"),
    )
    enough_ahead = F.col("before") & (F.col("ahead") - F.col("until") + F.col("n") >= reach)
    enough_behind = F.col("after") & (F.col("until") - F.col("through") >= reach)
    found = placed.groupBy(*domain.series, "first").agg(
        F.coalesce(F.max(F.when(enough_ahead, month)), F.min("month")).alias("low"),
        F.coalesce(F.min(F.when(enough_behind, month)), F.max("month")).alias("high"),
    )
    return found.select(*[F.col(c).alias(f"of_{c}") for c in domain.series], "first", "low", "high")


def _within(rows: DataFrame, bounds: DataFrame, domain: Domain, start: str, how: str = "left_semi") -> DataFrame:
    """Rows of the series and months from ``start`` to ``high``, or all others."""
    own = [rows[c].eqNullSafe(bounds[f"of_{c}"]) for c in domain.series]
    return rows.join(bounds, reduce(and_, own) & rows[MONTH].between(bounds[start], bounds["high"]), how)


def reached_months(
    domain: Domain, counts: DataFrame, changed: DataFrame, reach: int, whole: Sequence[str] = ()
) -> DataFrame:
    """Per series with rows to build (its columns behind ``of_``): ``written``, the months
    with rows that a change reaches, and those of ``whole``, which all series write, and
    ``read``, those and the months ahead that windows of ``reach`` observations start from.
    ``changed`` has the month."""
    marks = changed.select(*domain.series, F.col(MONTH).alias("month")).distinct().withColumn("changed", F.lit(True))
    listed = F.col("month").isin(list(whole))
    series = marks.select(*domain.series)
    if whole:
        series = series.unionByName(counts.filter(listed).select(*domain.series))
    rows = counts.join(series.distinct(), list(domain.series), "left_semi")
    along = Window.partitionBy(*domain.series).orderBy("month")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    from_here = along.rowsBetween(0, Window.unboundedFollowing)
    n, until = F.col("observations"), F.col("until")
    counted = rows.join(marks, [*domain.series, "month"], "left").withColumn("until", F.sum(n).over(so_far))
    behind = until - n - F.max(F.when(F.col("changed"), until)).over(so_far)
    written = counted.withColumn("written", F.coalesce(behind < reach, F.lit(False)) | listed)
    ahead = F.min(F.when(F.col("written"), until - n)).over(from_here) - until
    placed = written.withColumn("read", F.coalesce(ahead < reach, F.lit(False)))
    lists = [F.collect_list(F.when(F.col(c), F.col("month"))).alias(c) for c in ("read", "written")]
    series = [F.col(c).alias(f"of_{c}") for c in domain.series]
    return placed.filter("read").groupBy(*domain.series).agg(*lists).select(*series, "read", "written")


def mostly_reached(counts: DataFrame, reached: DataFrame) -> list[str]:
    """Months in which changes reach at least half of the series."""
    written = reached.select(F.explode("written").alias("month")).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    known = counts.groupBy("month").agg(F.count(F.lit(1)).alias("of"))
    return sorted(r["month"] for r in written.join(known, "month").filter(2 * F.col("n") >= F.col("of")).collect())


def _of_months(rows: DataFrame, reached: DataFrame, domain: Domain, months: str, how: str = "left_semi") -> DataFrame:
    """Rows of the series' months that ``reached`` lists as ``months``, or all others. Keys
    of a series are never null in Silver and Gold."""
    own = [rows[c] == reached[f"of_{c}"] for c in domain.series]
    listed = F.array_contains(reached[months], rows[MONTH])
    return rows.join(reached.select(*[f"of_{c}" for c in domain.series], months), reduce(and_, own) & listed, how)


def _changes(new: DataFrame, old: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that ``old`` does not have."""
    return new.join(old, _same(new, old, columns), "left_anti")


def _versions(spark: SparkSession, table: str, since: int, until: int, prefix: str) -> tuple[DataFrame, DataFrame]:
    return read_version(spark, table, since, prefix), read_version(spark, table, until, prefix)


def _counted(spark: SparkSession, df: DataFrame, table: str, months: list[str] | None, prefix: str, **book) -> int:
    return write_counted(lambda seen: replace(df, table, seen, months=months, prefix=prefix, **book))


def update_silver(spark: SparkSession, domain: Domain, prefix: str = "") -> int:
    """Merge the loads that the current version does not hold; returns the rows written."""
    before = current_version(spark, domain.silver, prefix)
    held = loads_in(spark, domain.silver, before, prefix)
    new = [part for part in booked_parts(spark, domain.raw, prefix) if part not in held]
    if not new:
        return 0
    fresh = domain.clean(rows_of(spark, domain.raw, new, prefix)).withColumn(MONTH, month_of(domain.silver))
    months = _months(fresh, MONTH)
    old = read_version(spark, domain.silver, before, prefix).filter(F.col(MONTH).isin(months))
    merged = domain.merge(old.unionByName(fresh)).select(*columns_of(domain.silver))
    return _counted(spark, merged, domain.silver, months, prefix, loads=[*held, *new])


def update_gold(spark: SparkSession, domain: Domain, prefix: str = "") -> list[str]:
    """Follow what Silver has changed; returns the Gold months written."""
    before, after = source_of(spark, domain.gold, prefix), current_version(spark, domain.silver, prefix)
    touched = months_moved(spark, domain.silver, before, after, prefix)
    if not touched:
        return []
    old, now = _versions(spark, domain.silver, before, after, prefix)
    of_months = now.filter(F.col(MONTH).isin(touched))
    changed = _changes(of_months, old.filter(F.col(MONTH).isin(touched)), columns_of(domain.silver))
    _counted(spark, series_months(domain, of_months.drop(MONTH)), domain.months, touched, prefix)
    counts = scan(spark, domain.months, prefix)
    some = reached_months(domain, counts, changed, domain.reach)
    whole = mostly_reached(counts, some)
    reached = reached_months(domain, counts, changed, domain.reach, whole) if whole else some
    flat = reached.select(F.explode("read").alias("month"), F.array_contains("written", F.col("month")).alias("written"))
    found = flat.groupBy("month").agg(F.max("written").alias("written")).collect()
    read, written = sorted(r["month"] for r in found), sorted(r["month"] for r in found if r["written"])
    source = _of_months(now.filter(F.col(MONTH).isin(read)), reached, domain, "read").drop(MONTH)

    def own(built: DataFrame) -> DataFrame:
        return _of_months(built.withColumn(MONTH, month_of(domain.gold)), reached, domain, "written")

    rows = rows_by_month(domain.gold, domain.build, source, only=own)
    if partly := [month for month in written if month not in whole]:
        gold = read_version(spark, domain.gold, current_version(spark, domain.gold, prefix), prefix)
        kept = _of_months(gold.filter(F.col(MONTH).isin(partly)), reached, domain, "written", "left_anti")
        rows = rows.unionByName(gathered(kept, domain.gold))
    book = {"source": after, "by_month": True}
    _counted(spark, rows.select(*columns_of(domain.gold), MONTH), domain.gold, written, prefix, **book)
    return written


def update_by_month(
    spark: SparkSession, state: str, table: str, build: Callable[[DataFrame], DataFrame], prefix: str = ""
) -> None:
    """A state of a table's months, of those that have been written since."""
    before, after = source_of(spark, state, prefix), current_version(spark, table, prefix)
    months = months_moved(spark, table, before, after, prefix)
    if months:
        rows = read_version(spark, table, after, prefix).filter(F.col(MONTH).isin(months))
        replace(build(rows), state, months=months, source=after, prefix=prefix)


def update_breadth(spark: SparkSession, domain: Domain, prefix: str = "") -> None:
    """Breadth per date of the months that Gold has written."""
    table, by_date = BREADTH[domain.gold]
    update_by_month(spark, table, domain.gold, by_date, prefix)


def update_report_states(spark: SparkSession, prefix: str = "") -> None:
    """What reports and checks are put together from."""
    for state, (table, build) in report_states.BUILDERS.items():
        update_by_month(spark, state, table, build, prefix)


def update_macro_changes(spark: SparkSession, prefix: str = "") -> None:
    """The old rows' differences off, the new rows' on, per date."""
    domain, table = MACRO, "macro_changes"
    before, after = source_of(spark, table, prefix), current_version(spark, domain.gold, prefix)
    moved = months_moved(spark, domain.gold, before, after, prefix)
    if not moved:
        return
    old, now = _versions(spark, domain.gold, before, after, prefix)
    changed = _changes(now.filter(F.col(MONTH).isin(moved)), old.filter(F.col(MONTH).isin(moved)), columns_of(domain.gold))
    counts = scan(spark, domain.months, prefix)
    # A row is compared with the one before it, and the one after it with this row.
    bounds = reaches(domain, counts, changed, 1)
    read = _months(_within(counts.withColumnRenamed("month", MONTH), bounds, domain, "low"), MONTH)
    marks = bounds.select(*[F.col(f"of_{c}").alias(c) for c in domain.series], F.col("first").alias("_first"))

    def steps(rows: DataFrame) -> DataFrame:
        own = _within(rows.filter(F.col(MONTH).isin(read)), bounds, domain, "low")
        return macro_changes_by_date(own.join(marks, list(domain.series)), F.col(MONTH) >= F.col("_first"))

    states, columns = scan(spark, table, prefix), columns_of(table)[1:]
    off = steps(old).select("as_of_date", *[(-F.col(c)).alias(c) for c in columns])
    parts = states.unionByName(steps(now)).unionByName(off)
    summed = parts.groupBy("as_of_date").agg(*[F.sum(c).cast(states.schema[c].dataType).alias(c) for c in columns])
    # One row per date, so the whole state is written.
    replace(summed, table, source=after, prefix=prefix)


def rebuild_states(spark: SparkSession, prefix: str = "") -> None:
    """All states from whole Silver and Gold tables, to go on from."""
    for domain in DOMAINS:
        replace(series_months(domain, scan(spark, domain.silver, prefix)), domain.months, prefix=prefix)
    built = {
        **{state: (gold, build) for gold, (state, build) in BREADTH.items()},
        "macro_changes": (MACRO.gold, macro_changes_by_date),
        **report_states.BUILDERS,
    }
    for state, (table, build) in built.items():
        version = current_version(spark, table, prefix)
        replace(build(read_version(spark, table, version, prefix)), state, source=version, prefix=prefix)


def full_build(spark: SparkSession, prefix: str = "") -> None:
    rebuild_silver(spark, prefix)
    rebuild_gold(spark, prefix)
    rebuild_states(spark, prefix)


def update_summary(spark: SparkSession, prefix: str = "") -> int:
    """The summary from the states, the movers from it and the newest month."""
    states = [scan(spark, name, prefix) for name in ("market_breadth", "fx_breadth", "macro_changes")]
    rows = _counted(spark, summary_of(*states), "cross_signal_summary", None, prefix)
    newest = latest_rows(Catalog(spark, prefix)[MARKET.gold], "snapshot_date")
    movers = movers_of_summary(newest, scan(spark, "cross_signal_summary", prefix))
    return rows + _counted(spark, movers, "top_movers_why", None, prefix)


def update(spark: SparkSession, prefix: str = "") -> dict[str, list[str]]:
    """Bring Silver, Gold and the states up to the loads booked, each with an audit row;
    returns the months of Gold written per domain."""
    with shuffles_freed(spark):
        return _update(spark, prefix)


def _update(spark: SparkSession, prefix: str) -> dict[str, list[str]]:
    written: dict[str, list[str]] = {}
    for domain in DOMAINS:

        def gold(domain=domain) -> int:
            written[domain.gold] = update_gold(spark, domain, prefix)
            return len(written[domain.gold])

        audited(spark, f"update_{domain.silver}", lambda d=domain: update_silver(spark, d, prefix), prefix)
        audited(spark, f"update_{domain.gold}", gold, prefix)
    for domain in (MARKET, FX):
        update_breadth(spark, domain, prefix)
    update_macro_changes(spark, prefix)
    update_report_states(spark, prefix)
    audited(spark, "update_cross_signal_summary", lambda: update_summary(spark, prefix), prefix)
    return written
