"""Append-only JSON logs: checkpoints, run summaries, health checks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.maintenance import footer_drift
from ..schemas import CHECKPOINT_SCHEMA, HEALTH_SCHEMA, TRANSFORMED_SCHEMA
from ..session import create_text, list_files, modified, path_exists, read_text, remove_path
from ..sources.checkpoints import SNAPSHOTS, checkpoint_files, latest_snapshot, snapshot_records
from ..sources.footers import table_footers


def checkpoint_record(
    spark: SparkSession,
    job_name: str,
    last_processed_date: str,
    updated_at: str,
    status: str = "success",
    execution_id: str = "manual",
) -> DataFrame:
    row = (job_name, last_processed_date, status, updated_at, execution_id)
    return spark.createDataFrame([row], CHECKPOINT_SCHEMA)


def append_checkpoint(records: DataFrame, path: str) -> None:
    """Upsert by appending: the newest record per job is the current one."""
    records.select(*CHECKPOINT_SCHEMA.names).write.mode("append").json(path)


def append_run_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("append").json(path)


def append_health_results(results: DataFrame, root: str, day: Column | str = "timestamp") -> None:
    """Append check results to the folder of their day, the leading date of ``day``."""
    day = F.col(day) if isinstance(day, str) else day
    dated = results.select(*HEALTH_SCHEMA.names, F.substring(day, 1, 10).alias("day"))
    dated.hint("rebalance", "day").write.mode("append").partitionBy("day").json(root)


def append_layout_changes(
    spark: SparkSession,
    table: str,
    days: Sequence[str],
    log: str,
    updated_at: str,
    expected: T.StructType = TRANSFORMED_SCHEMA,
) -> None:
    """Logs how the files of these days differ from the declared layout, by their footers; nothing is applied.

    One record for each day and column that is not as declared.
    """
    drift = footer_drift(table_footers(spark, table, days), expected).where("status <> 'ok'")
    drift.withColumn("updated_at", F.lit(updated_at)).write.mode("append").json(log)


def compact_checkpoints(spark: SparkSession, path: str) -> int:
    """Puts the records that still matter into a snapshot and returns its number.

    Those are each job's newest record and its newest success, so readers find the same as
    in the whole log (:func:`fieldgauge.sources.read_checkpoint`) from as many rows as
    there are jobs and what was appended since. A snapshot counts once its manifest
    exists, which names the files that it covers; a run that dies before leaves the log as
    it was. Two runs at a time make one snapshot. Covered files stay until
    :func:`remove_covered` finds them old enough.
    """
    number, before = latest_snapshot(spark, path)
    files = checkpoint_files(spark, path, before)
    if not files:
        return number
    folder = f"{SNAPSHOTS}/{uuid.uuid4().hex}"
    snapshot_records(spark, path).write.json(f"{path}/{folder}")
    record = {"folder": folder, "covers": sorted({*before.get("covers", ()), *files} & {n for n, _ in list_files(spark, path)})}
    created = create_text(spark, f"{path}/{SNAPSHOTS}/{number + 1:020d}.json", json.dumps(record))
    return number + 1 if created else latest_snapshot(spark, path)[0]


def remove_covered(spark: SparkSession, path: str, before: datetime) -> int:
    """Removes log files that the newest snapshot covers and older snapshots, if older than ``before``; how many."""
    number, newest = latest_snapshot(spark, path)
    held = {name for name, _ in list_files(spark, path)}
    old = [f"{path}/{name}" for name in newest.get("covers", ()) if name in held]
    for name, _ in list_files(spark, f"{path}/{SNAPSHOTS}"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < number:
            folder = json.loads(read_text(spark, f"{path}/{SNAPSHOTS}/{name}"))["folder"]
            # The folder first: a run that dies in between finds it again by its manifest.
            old += [f for f in (f"{path}/{folder}", f"{path}/{SNAPSHOTS}/{name}") if path_exists(spark, f)]
    gone = [f for f in old if modified(spark, f) < before.timestamp() * 1000]
    for file in gone:
        remove_path(spark, file)
    return len(gone)
