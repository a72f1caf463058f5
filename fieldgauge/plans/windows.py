"""Incremental windows from checkpoints."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import LOOKBACK_DAYS


def incremental_window(
    jobs: DataFrame,
    checkpoints: DataFrame,
    end: date,
    as_of: date,
    start: date | None = None,
    lookback: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Dates each job has still to process.

    A job resumes the day after its checkpoint. Without one it starts at
    ``start``, or ``lookback`` days before ``as_of``. ``has_work`` is false when
    nothing is left up to ``end``. ``checkpoints`` holds one row per job.
    """
    resume = F.date_add(F.to_date("last_processed_date"), 1)
    first = F.coalesce(resume, F.lit(start).cast("date"), F.date_sub(F.lit(as_of), lookback))
    joined = jobs.select("job_name").join(checkpoints, "job_name", "left")
    return joined.select(
        "job_name",
        "last_processed_date",
        F.coalesce("status", F.lit("new")).alias("status"),
        fx.iso_day(first).alias("start_date"),
        F.lit(end.isoformat()).alias("end_date"),
        (first <= F.lit(end)).alias("has_work"),
    )


def rows_between(df: DataFrame, start: Column | str, end: Column | str, day: str = "dt") -> DataFrame:
    """Rows of the inclusive day range; on a stored table this prunes day folders."""
    start = F.lit(start) if isinstance(start, str) else start
    end = F.lit(end) if isinstance(end, str) else end
    return df.where(F.col(day).between(start, end))
