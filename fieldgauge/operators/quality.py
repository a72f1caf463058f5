"""Completeness metrics and the summary record of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completeness_rate(complete: Column, total: Column) -> Column:
    """Percentage, and 0 when there are no rows."""
    return F.when(total == 0, F.lit(0.0)).otherwise(complete.cast("double") / total * 100)


def quality_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row, completeness and missing-value counts of transformed observations.

    One pass; without ``by`` the result is one row even for an empty input.
    """
    total, complete = F.count("*"), F.count_if("is_complete")
    return df.groupBy(*by).agg(
        total.alias("total_rows"),
        complete.alias("complete_rows"),
        completeness_rate(complete, total).alias("completeness_rate"),
        F.count_if(F.col("temperature_avg").isNull()).alias("null_temperature_count"),
        F.count_if(F.col("precipitation").isNull()).alias("null_precipitation_count"),
    )


def run_summary(
    df: DataFrame,
    missing: DataFrame,
    start_date: str,
    end_date: str,
    job_name: str,
    execution_id: str = "unknown",
    updated_at: Column | None = None,
    status: str = "success",
    planned: DataFrame | None = None,
    received: DataFrame | None = None,
    counted: tuple[int, int] | None = None,
) -> DataFrame:
    """One record describing a run over transformed observations.

    ``missing`` holds the planned sensor-days that never arrived, ``planned`` the
    sensors of the plan and ``received`` the rows before deduplication; without
    the last two, sensors and rows are those of ``df``. ``counted`` gives the rows and
    complete rows of ``df`` if they are known; with ``planned`` and ``received`` as well,
    ``df`` is not read at all.
    """
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if updated_at is None else updated_at
    total, complete = F.count("*"), F.count_if("is_complete")
    if counted and planned is not None and received is not None:
        total, complete = (F.max(F.lit(n).cast("long")) for n in counted)
        df = df.sparkSession.range(1)
    failed = missing.agg(F.count("*")).scalar()
    sensors = F.countDistinct("sensor_id") if planned is None else planned.agg(F.count("*")).scalar()
    rows = total if received is None else received.agg(F.count("*")).scalar()
    return df.agg(
        sensors.alias("num_sensors"),
        rows.alias("rows_processed"),
        completeness_rate(complete, total).alias("data_quality_rate"),
    ).select(
        F.lit(end_date).alias("last_processed_date"),
        F.lit(start_date).alias("start_date"),
        F.lit(end_date).alias("end_date"),
        "num_sensors",
        "rows_processed",
        failed.alias("failed_fetches"),
        "data_quality_rate",
        F.lit(status).alias("status"),
        F.lit(job_name).alias("job_name"),
        F.lit(execution_id).alias("execution_id"),
        stamp.alias("updated_at"),
    )
