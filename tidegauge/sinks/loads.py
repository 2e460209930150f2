"""Raw rows, load by load, each exactly once.

A load writes its rows into a partition of its own and then one row into the ledger.
The ledger row is what makes the rows visible: the raw table's name is a view of the
partitions that the ledger lists, one for each load id. So a load that fails half-way
leaves nothing to be seen, and one that is run again after it was booked, say because
the audit row or the answer got lost, adds nothing. Two runs of one load at once may
both write; one of them is shown.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegauge.sinks.tables import append, counted, gathered, loads_of, side_by_side
from tidegauge.sources.schemas import BOOKS, LOAD, columns_of
from tidegauge.sources.tables import scan


class LoadConflict(RuntimeError):
    """A load id comes again with other rows."""


@dataclass(frozen=True)
class Load:
    load_id: str
    rows: int
    repeated: bool = False


#: Bits of a part of a row hash; three parts make up its 64 bits.
PART_BITS = 22


def _content(table: str) -> list[Column]:
    """A sum over row hashes: equal for equal rows, in whatever order they come.

    The hashes are summed in three parts, which are exact as bigints for 2^41 rows and
    take a third of the time of decimals; :func:`_content_of` puts the sum together.
    """
    row_hash = F.xxhash64(*columns_of(table))
    low = F.lit((1 << PART_BITS) - 1).cast("long")
    parts = [row_hash.bitwiseAND(low), F.shiftright(row_hash, PART_BITS).bitwiseAND(low)]
    parts.append(F.shiftright(row_hash, 2 * PART_BITS))
    return [F.coalesce(F.sum(part), F.lit(0)).alias(f"content_{i}") for i, part in enumerate(parts)]


def _content_of(facts: Mapping[str, int]) -> Decimal:
    return Decimal(sum(facts[f"content_{i}"] << (i * PART_BITS) for i in range(3)))


def booked(spark: SparkSession, table: str, prefix: str = "") -> DataFrame:
    """The ledger's rows of a table, one for each load id."""
    ledger = scan(spark, "load_ledger", prefix).filter(F.col("table_name") == table)
    first = F.min(F.struct("part", "row_count", "content")).alias("first")
    return ledger.groupBy("load_id").agg(first).select("load_id", "first.*")


def load(rows: DataFrame, table: str, load_id: str | None = None, prefix: str = "") -> Load:
    """Append rows to a raw table under a load id, a new one if none is given.

    An id that is booked already adds nothing if its rows are the same, which is
    asked of their hashes, and fails if they are not.
    """
    spark, columns = rows.sparkSession, columns_of(table)
    rows = rows.select(*columns)
    if load_id is not None:
        known = booked(spark, table, prefix).filter(F.col("load_id") == load_id).first()
        if known:
            now = rows.agg(F.count(F.lit(1)).alias("rows"), *_content(table)).first()
            if (now["rows"], _content_of(now)) != (known["row_count"], known["content"]):
                raise LoadConflict(f"{table}: load {load_id} was booked with other rows")
            return Load(load_id, 0, repeated=True)
    load_id = load_id or uuid.uuid4().hex
    part, seen, name = f"{load_id}.{uuid.uuid4().hex}", Observation(), loads_of(table, prefix)
    written = counted(gathered(rows.withColumn(LOAD, F.lit(part)), table), seen, *_content(table))
    with side_by_side(spark):
        written.select(*spark.read.table(name).columns).write.insertInto(name)
    facts = seen.get
    book(spark, table, load_id, part, facts["rows"], _content_of(facts), prefix)
    return Load(load_id, facts["rows"])


def book(spark: SparkSession, table: str, load_id: str, part: str, rows: int, content, prefix: str = "") -> None:
    """The ledger row that shows a load's rows."""
    row = (table, load_id, part, rows, Decimal(content), datetime.now(timezone.utc))
    append(spark.createDataFrame([row], BOOKS["load_ledger"][1]), "load_ledger", prefix)


def rows_of(spark: SparkSession, table: str, parts: list[str], prefix: str = "") -> DataFrame:
    """The raw rows of these loads; other loads' files are not read."""
    return spark.read.table(loads_of(table, prefix)).filter(F.col(LOAD).isin(parts)).select(*columns_of(table))


def booked_parts(spark: SparkSession, table: str, prefix: str = "") -> list[str]:
    return sorted(r["part"] for r in booked(spark, table, prefix).select("part").collect())
