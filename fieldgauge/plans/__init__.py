"""Planning of collection and the daily load."""

from .collection import (
    assign_zone,
    chunk_ranges,
    collection_plan,
    date_spine,
    days_between,
    expected_rows,
    request_ranges,
    sensor_dimension,
    sensor_grid,
)
from .daily import run_daily
from .windows import incremental_window, rows_between

__all__ = [
    "assign_zone",
    "chunk_ranges",
    "collection_plan",
    "date_spine",
    "days_between",
    "expected_rows",
    "incremental_window",
    "request_ranges",
    "rows_between",
    "run_daily",
    "sensor_dimension",
    "sensor_grid",
]
