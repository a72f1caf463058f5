"""The daily load from landed observations to table, checkpoint and summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.gaps import missing_in_range, not_stored
from ..operators.quality import run_summary
from ..schemas import RUN_SUMMARY_SCHEMA
from ..sinks.logs import append_checkpoint, append_run_summary, checkpoint_record
from ..sinks.observations import upsert_days
from ..sources.checkpoints import read_checkpoint
from ..sources.tables import read_version
from ..versions import Version, latest_version
from .windows import incremental_window, rows_between


def run_daily(
    observations: DataFrame,
    sensors: DataFrame,
    root: str,
    job_name: str,
    end: date,
    as_of: date,
    updated_at: str,
    start: date | None = None,
    execution_id: str = "manual",
    tie_break: Sequence[str] = (),
    max_days: int | None = None,
    late_days: int = 0,
) -> DataFrame | None:
    """Load the days a job has still to process; None when there are none.

    ``max_days`` takes at most that many of them, oldest first. Calling until None
    comes back loads a long history in bounded steps: deduplication and regional
    aggregates never reach across days, so the result is the same, each step
    shuffles its own days only, and a lost driver costs one step.

    ``late_days`` also looks at that many days before the window, not before
    ``start``: what is not stored there, or newer than what is stored, is merged in,
    also when the window is empty. So late records and sensor-days once counted as
    missing are loaded when they arrive. Days without any are not rewritten.

    ``root`` holds ``table``, ``checkpoints`` and ``runs``. Days are published by one
    commit (see :mod:`fieldgauge.versions`); the checkpoint moves only after that, so a
    failed run is simply repeated, and its record takes the place of the one before. What
    the summary says of the rows is observed while they are written; only where the window
    holds days that this run did not write is it counted from the table.
    """
    spark = observations.sparkSession
    job = spark.range(1).select(F.lit(job_name).alias("job_name"))
    checkpoint = read_checkpoint(spark, f"{root}/checkpoints", job_name)
    window = incremental_window(job, checkpoint, end, as_of, start).first()
    first, last = window.start_date, window.end_date
    table = f"{root}/table"
    earlier = None
    before = latest_version(spark, table)
    if late_days and before.folders():
        since = (date.fromisoformat(first) - timedelta(days=late_days)).isoformat()
        since = max(since, start.isoformat()) if start else since
        until = (date.fromisoformat(first) - timedelta(days=1)).isoformat()
        stored = read_version(spark, table, before, since=since, until=until)
        earlier = not_stored(rows_between(observations, since, until), stored)
    if not window.has_work:
        if earlier is not None:
            upsert_days(earlier, table, tie_break)
        return None
    if max_days:
        last = min(last, (date.fromisoformat(first) + timedelta(days=max_days - 1)).isoformat())
    batch = rows_between(observations, first, last)
    version = upsert_days(
        batch if earlier is None else batch.unionByName(earlier), table, tie_break, observe=window_metrics(first, last)
    )
    days = version.changed.get("rows", []) if version.number > before.number else []
    if not days and rows_between(observations, first, window.end_date).isEmpty():
        raise ValueError(f"no observations from {first} to {window.end_date}")
    # An empty step before later data moves on; its days are recorded as missing.
    written = read_version(spark, table, version, since=first, until=last)
    summary = run_summary(
        written,
        missing_in_range(sensors, written, date.fromisoformat(first), date.fromisoformat(last)),
        first,
        last,
        job_name,
        execution_id,
        F.lit(updated_at),
        planned=sensors,
        received=batch,
        counted=observed_counts(version, days, first, last),
    )
    # One row: kept as a value, so that using the result runs nothing again.
    summary = spark.createDataFrame([summary.select(*RUN_SUMMARY_SCHEMA.names).first()], RUN_SUMMARY_SCHEMA)
    append_run_summary(summary, f"{root}/runs")
    append_checkpoint(checkpoint_record(spark, job_name, last, updated_at, "success", execution_id), f"{root}/checkpoints")
    return summary


def window_metrics(first: str, last: str) -> list[Column]:
    """What to observe of transformed rows while they are written: all and the complete ones of a range of days."""
    inside = F.col("dt").between(first, last)
    return [F.count_if(inside).alias("rows"), F.count_if(inside & F.col("is_complete")).alias("complete")]


def observed_counts(version: Version, days: Sequence[str], first: str, last: str) -> tuple[int, int] | None:
    """Rows and complete rows of a range of days as the commit observed them; None unless it wrote them all."""
    held = {day for day in version.folders() if first <= day <= last}
    if not held <= set(days) or "rows" not in version.metrics:
        return None
    return version.metrics["rows"], version.metrics["complete"]
