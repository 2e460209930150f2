"""Silver, Gold and state tables, version by version.

A version is a table of its own, ``name__v3``, whose month partitions lie in one or
more folders: a full rebuild writes all months anew, a partial one writes some and
points the others to the folders they have. The name itself is a view that
``ALTER VIEW`` moves in one step, so there is no moment without the table, a rebuild
that fails leaves it as it was, and a reader that has begun goes on with its version's
files. Old versions stay until :func:`collect_versions` takes them away.

The book ``table_versions`` says where the months of a version lie, which raw loads
went into it, and which version of its source it was built from, so that a later job
finds out what has changed since, also if the one before it failed half-way.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegauge.sinks.tables import FILE_ROWS, append, counted, gathered, new_folder, side_by_side
from tidegauge.sources.schemas import ALL_TABLES, BOOKS, MONTH, qualified
from tidegauge.sources.tables import scan


class VersionConflict(RuntimeError):
    """Another writer replaced the table meanwhile."""


def current_version(spark: SparkSession, table: str, prefix: str = "") -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(table, prefix)}").collect()
    text = next(r[1] for r in rows if r[0] == "View Text")
    return int(re.search(r"__v(\d+)", text).group(1))


def read_version(spark: SparkSession, table: str, version: int, prefix: str = "") -> DataFrame:
    """A version's rows with their month."""
    return spark.read.table(f"{qualified(table, prefix)}__v{version}")


def _booked(spark: SparkSession, table: str, version: int, kind: str, prefix: str) -> dict[str, str]:
    """Months (with their folder) or loads of a version: as many as the calendar and
    the history of loads have."""
    book = scan(spark, "table_versions", prefix).filter(
        (F.col("table_name") == table) & (F.col("version") == version) & (F.col("kind") == kind)
    )
    return {r["part"]: r["folder"] for r in book.select("part", "folder").collect()}


def months_moved(spark: SparkSession, table: str, since: int, until: int, prefix: str = "") -> list[str]:
    """Months that were written between two versions: those in other folders."""
    old, new = (_booked(spark, table, v, "month", prefix) for v in (since, until))
    return sorted(m for m in {*old, *new} if old.get(m) != new.get(m))


def source_of(spark: SparkSession, table: str, prefix: str = "") -> int:
    """The version of its source that the table was built from, 0 (empty) at first."""
    booked = _booked(spark, table, current_version(spark, table, prefix), "source", prefix)
    return max(map(int, booked), default=0)


def loads_in(spark: SparkSession, table: str, version: int, prefix: str = "") -> set[str]:
    return set(_booked(spark, table, version, "load", prefix))


def replace(
    df: DataFrame,
    table: str,
    seen: Observation | None = None,
    months: Iterable[str] | None = None,
    loads: Sequence[str] = (),
    source: int | None = None,
    prefix: str = "",
    by_month: bool = False,
) -> int:
    """Write a new version and move the name to it; returns its number.

    With ``months`` the rows are those of these months, and all other months stay as
    they are, without being read. ``loads`` are the raw loads that the rows hold,
    ``source`` is the version of the table that they come from. The plan may read the
    version before, and may have gathered its rows ``by_month`` already.
    """
    spark = df.sparkSession
    before = current_version(spark, table, prefix)
    folder = new_folder(spark, table, prefix)
    rows = counted(df if by_month else gathered(df, table), seen)
    with side_by_side(spark):
        rows.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(MONTH).parquet(folder)
    kept = {} if months is None else _booked(spark, table, before, "month", prefix)
    held = {m: f for m, f in kept.items() if m not in set(months or ())}
    new = spark.read.schema(f"{MONTH} string").parquet(folder).distinct().collect()
    held |= {r[MONTH]: folder for r in new}
    version = _next(spark, table, before, prefix)
    listed = ", ".join(f"`{field}` {kind}" for field, kind in rows.dtypes)
    _publish(spark, table, before, version, listed, folder, held, loads, source, prefix)
    return version


def _next(spark: SparkSession, table: str, before: int, prefix: str) -> int:
    booked = scan(spark, "table_versions", prefix).filter(F.col("table_name") == table).agg(F.max("version")).first()[0]
    return max(before, booked or 0) + 1


def _publish(
    spark: SparkSession, table: str, before: int, version: int, listed: str, folder: str,
    months: Mapping[str, str], loads: Sequence[str], source: int | None, prefix: str,
) -> None:
    name = qualified(table, prefix)
    versioned = f"{name}__v{version}"
    # Fails if another writer has taken the number.
    spark.sql(f"CREATE TABLE {versioned} ({listed}) USING parquet PARTITIONED BY ({MONTH}) LOCATION '{folder}'")
    if months:
        specs = [f"PARTITION ({MONTH} = '{m}') LOCATION '{f}/{MONTH}={m}'" for m, f in sorted(months.items())]
        spark.sql(f"ALTER TABLE {versioned} ADD {' '.join(specs)}")
    now = datetime.now(timezone.utc)
    rows = [(table, version, "month", m, f, now) for m, f in months.items()]
    rows += [(table, version, "load", part, None, now) for part in loads]
    rows += [(table, version, "source", str(source), None, now)] if source is not None else []
    rows += [(table, version, "written", None, folder, now)]
    append(spark.createDataFrame(rows, BOOKS["table_versions"][1]).coalesce(1), "table_versions", prefix)
    if current_version(spark, table, prefix) != before:
        raise VersionConflict(f"{name} was replaced while version {version} was written")
    spark.sql(f"ALTER VIEW {name} AS SELECT * FROM {versioned}")


def collect_versions(spark: SparkSession, table: str, keep: timedelta, prefix: str = "") -> list[int]:
    """Drop versions replaced longer than ``keep`` ago, and the files that only they
    have; returns their numbers. Readers of such a version must be done by then."""
    name, schema = qualified(table, prefix), f"{prefix}{ALL_TABLES[table][0]}"
    found = spark.sql(f"SHOW TABLES IN {schema} LIKE '{table}__v*'").collect()
    live = sorted(int(r["tableName"].rsplit("__v", 1)[1]) for r in found if re.fullmatch(rf"{table}__v\d+", r["tableName"]))
    current = current_version(spark, table, prefix)
    book = scan(spark, "table_versions", prefix).filter((F.col("table_name") == table) & F.col("version").isin(live))
    rows = book.select("version", "kind", "part", "folder", F.unix_micros("written_at").alias("at")).collect()
    written = {r["version"]: r["at"] for r in rows if r["kind"] == "written"}
    limit = (datetime.now(timezone.utc) - keep).timestamp() * 1e6
    shown = [v for v in live if v <= current]
    replaced = dict(zip(shown, shown[1:], strict=False))
    old = [v for v in shown if v in replaced and written.get(replaced[v], limit + 1) <= limit]
    held = {(r["folder"], r["part"]) for r in rows if r["kind"] == "month" and r["version"] not in old}
    folders = {folder for folder, _ in held}
    gone = {(r["folder"], r["part"]) for r in rows if r["kind"] == "month" and r["version"] in old} - held
    for version in old:
        spark.sql(f"DROP TABLE {name}__v{version}")
    for path in {f"{f}/{MONTH}={m}" if f in folders else f for f, m in gone}:
        _delete(spark, path)
    return old


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
