"""Planned against received observations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import OBSERVATION_KEYS


def missing_observations(plan: DataFrame, observed: DataFrame) -> DataFrame:
    """Planned ``(dt, sensor_id)`` pairs without any observation.

    Observed keys are made distinct before the join, map-side first, so both
    sides are unique on the join key and no key can be hot.
    """
    keys = list(OBSERVATION_KEYS)
    return plan.select(*keys).join(observed.select(*keys).distinct(), keys, "left_anti")


def missing_in_range(sensors: DataFrame, observed: DataFrame, start: date, end: date) -> DataFrame:
    """Days of the inclusive range on which a sensor has no observation.

    The same rows as :func:`missing_observations` for the plan of all sensors on
    all days, without shuffling that plan: observed days are collected per sensor,
    at most one entry for each day of the range and combined before the shuffle,
    and the gaps are listed next to each sensor.
    """
    days = F.transform(F.sequence(F.lit(start), F.lit(end)), lambda d: d.cast("string"))
    if start > end:
        days = F.array().cast("array<string>")
    seen = (
        observed.where(F.col("dt").between(start.isoformat(), end.isoformat()))
        .groupBy("sensor_id")
        .agg(F.collect_set("dt").alias("_seen"))
    )
    gaps = F.array_except(days, F.coalesce("_seen", F.array().cast("array<string>")))
    return sensors.join(seen, "sensor_id", "left").select(F.explode(gaps).alias("dt"), "sensor_id")


def missing_ranges(sensors: DataFrame, observed: DataFrame, start: date, end: date) -> DataFrame:
    """Each sensor's runs of days without an observation, as inclusive dates ``start_day`` and ``end_day``.

    Observed days are collected per sensor, at most one entry for each day of the range
    and combined before the shuffle. What lies between two of them, or between one and an
    end of the range, is a run, found next to the sensor: no plan of days is made.
    Repeated sensors give their runs each.
    """
    if start > end:
        return sensors.where(F.lit(False)).select(
            "sensor_id", F.lit(start).alias("start_day"), F.lit(end).alias("end_day")
        )
    seen = (
        observed.where(F.col("dt").between(start.isoformat(), end.isoformat()))
        .groupBy("sensor_id")
        .agg(F.collect_set(F.to_date("dt")).alias("_seen"))
    )
    before, behind = F.array(F.date_sub(F.lit(start), 1)), F.array(F.date_add(F.lit(end), 1))
    known = F.coalesce("_seen", F.array().cast("array<date>"))
    edges = F.sort_array(F.concat(before, known, behind))
    listed = sensors.join(seen, "sensor_id", "left").select("sensor_id", edges.alias("_edges"))
    pairs = F.arrays_zip(F.slice("_edges", 1, F.size("_edges") - 1).alias("a"), F.slice("_edges", 2, F.size("_edges") - 1).alias("b"))
    gaps = F.filter(pairs, lambda p: F.datediff(p["b"], p["a"]) > 1)
    return listed.select("sensor_id", F.explode(gaps).alias("_gap")).select(
        "sensor_id", F.date_add("_gap.a", 1).alias("start_day"), F.date_sub("_gap.b", 1).alias("end_day")
    )


def not_stored(observations: DataFrame, stored: DataFrame) -> DataFrame:
    """Observations whose sensor-day is not stored, or stored from an earlier record.

    ``stored`` holds one row per sensor and day. A filter on the observations' days
    reaches it through the join.
    """
    keys = list(OBSERVATION_KEYS)
    known = stored.select(*keys, F.col("ingestion_timestamp").alias("_stored"))
    joined = observations.join(known, keys, "left")
    newer = F.col("_stored").isNull() | (F.col("ingestion_timestamp") > F.col("_stored"))
    return joined.where(newer).select(*observations.columns)


def expected_vs_actual(days: DataFrame, sensors: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected and received sensor-days for every day of the spine.

    ``observed`` holds one row per sensor and day. It is counted per day before
    the join, so only one row per day is joined.
    """
    per_day = observed.groupBy("dt").agg(
        F.count("*").alias("actual_rows"),
        F.count_if(F.col("temperature_max").isNull() | F.col("temperature_min").isNull()).alias("null_temperature_rows"),
    )
    expected = sensors.agg(F.count("*")).scalar()
    joined = days.select("dt").join(per_day, "dt", "left")
    actual = F.coalesce("actual_rows", F.lit(0))
    return joined.select(
        "dt",
        expected.alias("expected_rows"),
        actual.alias("actual_rows"),
        (expected - actual).alias("missing_rows"),
        F.coalesce("null_temperature_rows", F.lit(0)).alias("null_temperature_rows"),
        F.col("actual_rows").isNotNull().alias("is_present"),
    )
