"""Regional daily aggregates attached to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def region_aggregates(df: DataFrame) -> DataFrame:
    """Add ``region_avg_temp`` and ``region_total_precipitation`` per region and day.

    Expects one row per sensor and day. Nulls are skipped; a group without any
    value gets null, and a null region or day forms a group. Totals are combined
    before their shuffle and joined back without a hint: adaptive execution
    broadcasts them when they turn out small, and otherwise splits a hot
    region-day over several tasks of the join. Both sides read the same rows, so
    their shuffle is done once; filter days before this operator, as a filter
    above it reaches one side only.
    """
    totals = df.groupBy(F.col("region").alias("_region"), F.col("dt").alias("_dt")).agg(
        F.avg("temperature_avg").alias("region_avg_temp"), F.sum("precipitation").alias("region_total_precipitation")
    )
    same_group = F.col("region").eqNullSafe(F.col("_region")) & F.col("dt").eqNullSafe(F.col("_dt"))
    return df.join(totals, same_group, "left").drop("_region", "_dt")
