"""Gold tables as Parquet and JSON files, written by the executors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOK_BACK_DAYS = 365

# Exported tables and the date that limits their JSON; None for
# tables that are exported as Parquet only.
EXPORTS = {
    "daily_market_snapshot": "snapshot_date",
    "fx_trend_signals": "rate_date",
    "cross_signal_summary": "as_of_date",
    "macro_indicator_trends": None,
    "top_movers_why": "as_of_date",
}


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def recent(
    df: DataFrame, date_column: str, today: str | date | None = None, days: int = LOOK_BACK_DAYS
) -> DataFrame:
    """Rows of the last ``days`` days."""
    until = F.current_date() if today is None else F.lit(today).cast("date")
    return df.filter(F.col(date_column) >= F.date_sub(until, days))


def json_ready(df: DataFrame) -> DataFrame:
    """Dates and times as ISO texts with all their digits, NaN as null."""

    def ready(name: str, kind: str):
        if kind == "date":
            return F.date_format(name, "yyyy-MM-dd")
        if kind.startswith("timestamp"):
            return F.col(name).cast("string")
        if kind in ("double", "float"):
            return F.nanvl(name, F.lit(None).cast(kind))
        return F.col(name)

    return df.select(*[ready(name, kind).alias(name) for name, kind in df.dtypes])


def export_json(
    df: DataFrame,
    path: str,
    date_column: str,
    today: str | date | None = None,
    days: int = LOOK_BACK_DAYS,
) -> None:
    """One JSON object per line, missing values as null."""
    rows = json_ready(recent(df, date_column, today, days))
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
