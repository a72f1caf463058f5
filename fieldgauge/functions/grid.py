"""Square grid of sensor locations around a centre point.

A grid for ``n`` sensors has ``ceil(sqrt(n))`` cells per side over half a degree
in each direction; cells are filled row by row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import GRID_SPAN_DEGREES

ROUNDING = 0.00005 + 1e-9


def _col(value: Column | str | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def grid_side(n: Column | str | int) -> Column:
    return F.ceil(F.sqrt(_col(n)))


def _row(ordinal: Column, side: Column) -> Column:
    return F.floor((ordinal - 1) / side)


def _place(centre: float, index: Column, side: Column) -> Column:
    step = F.lit(float(GRID_SPAN_DEGREES)) / side
    corner = F.lit(float(centre)) - F.lit(GRID_SPAN_DEGREES / 2)
    return F.round(corner + index * step, 4)


def grid_latitude(ordinal: Column | str, side: Column | str | int, centre: float) -> Column:
    return _place(centre, _row(_col(ordinal), _col(side)), _col(side))


def grid_longitude(ordinal: Column | str, side: Column | str | int, centre: float) -> Column:
    return _place(centre, (_col(ordinal) - 1) % _col(side), _col(side))


def zone_label(row: Column, column: Column) -> Column:
    return F.concat(F.lit("ZONE_"), row.cast("string"), F.lit("_"), column.cast("string"))


def grid_zone(ordinal: Column | str, side: Column | str | int) -> Column:
    ordinal, side = _col(ordinal), _col(side)
    return zone_label(_row(ordinal, side), (ordinal - 1) % side)


def sensor_label(ordinal: Column | str) -> Column:
    """Padded to four digits; longer numbers keep all their digits."""
    digits = _col(ordinal).cast("string")
    return F.concat(F.lit("SENSOR_"), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))


def zone_of_point(
    latitude: Column | str,
    longitude: Column | str,
    centre_latitude: float,
    centre_longitude: float,
    side: Column | str | int,
) -> Column:
    """Zone holding a coordinate; null outside the grid.

    Each cell holds its lower edges and not its upper ones. Grid coordinates are
    rounded, so half a unit of their last digit is allowed below an edge.
    """
    side = _col(side)
    step = F.lit(float(GRID_SPAN_DEGREES)) / side
    half = GRID_SPAN_DEGREES / 2
    row = F.floor((_col(latitude) - F.lit(centre_latitude - half) + ROUNDING) / step)
    column = F.floor((_col(longitude) - F.lit(centre_longitude - half) + ROUNDING) / step)
    inside = (row >= 0) & (row < side) & (column >= 0) & (column < side)
    return F.when(inside, zone_label(row, column))
