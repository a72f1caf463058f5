"""Presence of sensors by day as stored bitmaps, which can be or-ed, intersected and counted."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32_768  # of a bitmap, 4 KiB


def sensor_ordinal(sensor_id: str = "sensor_id") -> Column:
    """The number in a sensor's id, as the grid gives it from 1; null without one."""
    return F.regexp_extract(sensor_id, r"^SENSOR_(\d+)$", 1).try_cast("long")


def presence_bitmaps(observed: DataFrame, by: Sequence[str] = ("dt",), ordinal: str = "ordinal") -> DataFrame:
    """(by, bucket, present): which sensor ordinals have an observation, BITS of them to a row.

    To be stored: a day of a million sensors takes 31 rows of 4 KiB, and rows of the same
    bucket are or-ed for any range of days. Bits are set before the shuffle, so a task sends
    one row for each day and bucket. Rows without an ordinal are left out.
    """
    bucket = F.bitmap_bucket_number(ordinal).alias("bucket")
    present = F.bitmap_construct_agg(F.bitmap_bit_position(ordinal)).alias("present")
    return observed.where(F.col(ordinal).isNotNull()).groupBy(*by, bucket).agg(present)


def distinct_present(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, sensors): how many distinct sensors the bitmaps have together, over all of them or per group."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("present").alias("present"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("present")), F.lit(0)).alias("sensors"))


def missing_counts(bitmaps: DataFrame, planned: DataFrame, days: DataFrame) -> DataFrame:
    """(dt, planned, present, missing) for each of ``days``, from stored bitmaps and one of the planned sensors.

    ``planned`` has the bitmap rows (bucket, present) of the sensors of the plan; what others
    sent does not count. Only bitmaps are read and shuffled, some rows a day.
    """
    asked = planned.select("bucket", F.col("present").alias("wanted"))
    both = bitmaps.join(asked, "bucket").select(
        "dt", "bucket", F.explode(F.array("present", "wanted")).alias("bits")
    )
    kept = both.groupBy("dt", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    per_day = kept.groupBy("dt").agg(F.sum("n").alias("present"))
    total = planned.agg(F.coalesce(F.sum(F.bitmap_count("present")), F.lit(0))).scalar()
    present = F.coalesce("present", F.lit(0))
    return days.select("dt").join(per_day, "dt", "left").select(
        "dt", total.alias("planned"), present.alias("present"), (total - present).alias("missing")
    )


def absent_sensors(bitmaps: DataFrame, sensors: DataFrame, start: date, end: date, ordinal: str = "ordinal") -> DataFrame:
    """(dt, sensor_id): the days of the inclusive range without an observation, by testing each sensor's bit.

    A day and bucket without a bitmap has nobody present. The days' bitmaps of a bucket meet
    its sensors; adaptive execution splits buckets that are large.
    """
    placed = sensors.select(
        "sensor_id", F.bitmap_bucket_number(ordinal).alias("bucket"), F.bitmap_bit_position(ordinal).cast("int").alias("bit")
    )
    days = F.transform(F.sequence(F.lit(start), F.greatest(F.lit(start), F.lit(end))), lambda d: d.cast("string"))
    every_day = placed.select("bucket").distinct().select("bucket", F.explode(days).alias("dt"))
    asked = every_day.where(F.lit(start <= end)).join(bitmaps.select("dt", "bucket", "present"), ["dt", "bucket"], "left")
    byte = F.conv(F.hex(F.substring("present", F.expr("bit div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, F.col("bit") % 8) == 1, F.lit(False))
    return placed.join(asked, "bucket").where(~is_set).select("dt", "sensor_id")
