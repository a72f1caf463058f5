"""Column expressions: no shuffle, no Python in the row path."""

from .calendar import iso_day, resolve_date
from .grid import grid_latitude, grid_longitude, grid_zone, sensor_label, zone_of_point
from .measures import (
    banded,
    default_fill,
    is_complete,
    precipitation_level,
    quality_score,
    temperature_avg,
    temperature_category,
    temperature_range,
    to_fahrenheit,
)
from .requests import (
    failure_class,
    health_status,
    is_high_latency,
    is_rate_limit_low,
    response_outcome,
)

__all__ = [
    "banded",
    "default_fill",
    "failure_class",
    "grid_latitude",
    "grid_longitude",
    "grid_zone",
    "health_status",
    "is_complete",
    "is_high_latency",
    "is_rate_limit_low",
    "iso_day",
    "precipitation_level",
    "quality_score",
    "resolve_date",
    "response_outcome",
    "sensor_label",
    "temperature_avg",
    "temperature_category",
    "temperature_range",
    "to_fahrenheit",
    "zone_of_point",
]
