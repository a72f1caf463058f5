"""Which sensors are expected where and on which days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from ..functions.grid import grid_side
from ..operators.gaps import missing_ranges
from ..schemas import MAX_DAYS_PER_REQUEST


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive as ``dt``; none when reversed."""
    days = max(0, (end - start).days + 1)
    return spark.range(days).select(fx.iso_day(F.date_add(F.lit(start), F.col("id").cast("int"))).alias("dt"))


def days_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """Repeat each row for every day of its own inclusive range, as ``dt``.

    Ranges are date columns; a reversed one gives no row.
    """
    every_day = F.sequence(F.col(start), F.greatest(start, end))
    spread = df.select("*", F.explode(every_day).alias("_day")).where(F.col("_day") <= F.col(end))
    return spread.select(*df.columns, fx.iso_day("_day").alias("dt"))


def sensor_grid(df: DataFrame, ordinal: str, n: Column | int, latitude: float, longitude: float) -> DataFrame:
    """Sensor id, coordinates and zone of each 1-based ``ordinal`` among ``n`` sensors."""
    side = grid_side(n)
    return df.select(
        fx.sensor_label(ordinal).alias("sensor_id"),
        fx.grid_latitude(ordinal, side, latitude).alias("latitude"),
        fx.grid_longitude(ordinal, side, longitude).alias("longitude"),
        fx.grid_zone(ordinal, side).alias("region"),
    )


def sensor_dimension(spark: SparkSession, latitude: float, longitude: float, n: int) -> DataFrame:
    """``n`` sensors on a square grid around a centre, generated in parallel."""
    return sensor_grid(spark.range(1, n + 1), "id", n, latitude, longitude)


def collection_plan(sensors: DataFrame, start: date, end: date) -> DataFrame:
    """One row per sensor and day.

    Each sensor row is expanded where it lies: no join, no shuffle.
    """
    if start > end:
        return sensors.select("*", F.lit(None).cast("string").alias("dt")).where(F.lit(False))
    every_day = F.sequence(F.lit(start), F.lit(end))
    return sensors.select("*", F.explode(every_day).alias("_day")).select(
        *sensors.columns, fx.iso_day("_day").alias("dt")
    )


def expected_rows(sensors: DataFrame, start: date, end: date) -> DataFrame:
    """Sensors, days and planned rows, without building the plan."""
    days = max(0, (end - start).days + 1)
    return sensors.agg(
        F.count("*").alias("sensors"), F.lit(days).alias("days"), (F.count("*") * days).alias("expected_rows")
    )


def chunk_ranges(df: DataFrame, start: str, end: str, days: int = MAX_DAYS_PER_REQUEST) -> DataFrame:
    """Split each row's inclusive date range into consecutive ranges of at most ``days``.

    Adds ``chunk``, ``chunk_start`` and ``chunk_end``; a reversed range gives none.
    """
    last = F.floor(F.datediff(end, start) / F.lit(days)).cast("int")
    numbered = df.select("*", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias("chunk"))
    begin = F.date_add(start, F.col("chunk") * F.lit(days))
    return numbered.where(F.col(start) <= F.col(end)).select(
        "*",
        begin.alias("chunk_start"),
        F.least(F.date_add(begin, days - 1), F.col(end)).alias("chunk_end"),
    )


def request_ranges(
    sensors: DataFrame, observed: DataFrame, start: date, end: date, days: int = MAX_DAYS_PER_REQUEST
) -> DataFrame:
    """What to fetch again: requests of at most ``days`` that cover each sensor's missing days and no others.

    Columns ``sensor_id``, ``start_date`` and ``end_date`` (ISO, inclusive) and ``days``.
    """
    chunked = chunk_ranges(missing_ranges(sensors, observed, start, end), "start_day", "end_day", days)
    return chunked.select(
        "sensor_id",
        fx.iso_day("chunk_start").alias("start_date"),
        fx.iso_day("chunk_end").alias("end_date"),
        (F.datediff("chunk_end", "chunk_start") + 1).alias("days"),
    )


def assign_zone(
    df: DataFrame,
    centre_latitude: float,
    centre_longitude: float,
    side: Column | int,
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """Add the ``zone`` of each coordinate; null outside the grid."""
    return df.select(
        "*", fx.zone_of_point(latitude, longitude, centre_latitude, centre_longitude, side).alias("zone")
    )
