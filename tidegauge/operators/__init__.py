from tidegauge.operators.asof import changes_by_date, read_as_of
from tidegauge.operators.latest import ascending, dedupe_latest, descending, latest_rows, top_rows
from tidegauge.operators.series import over_long_series

__all__ = [
    "ascending",
    "changes_by_date",
    "dedupe_latest",
    "descending",
    "latest_rows",
    "over_long_series",
    "read_as_of",
    "top_rows",
]
