"""Checkpoint records: an append-only log of which the newest per job counts."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CHECKPOINT_SCHEMA, RUN_SUMMARY_SCHEMA
from ..session import list_files, path_exists, read_text

SNAPSHOTS = "_snapshots"


def latest_checkpoints(log: DataFrame) -> DataFrame:
    """Newest record per job, with the day of its newest success; combined before the shuffle.

    Work resumes after the last day processed successfully, so a newer failure shows
    in ``status`` but doesn't move ``last_processed_date``. Further columns are the
    newest record's.
    """
    fields = [c for c in log.columns if c != "job_name"]
    order = F.struct("updated_at", "last_processed_date", "execution_id")
    succeeded = F.when(F.col("status") == "success", order)
    newest = log.groupBy("job_name").agg(
        F.max_by(F.struct(*fields), order).alias("_record"), F.max_by("last_processed_date", succeeded).alias("_day")
    )
    rest = [f"_record.{c}" for c in fields if c != "last_processed_date"]
    return newest.select("job_name", F.col("_day").alias("last_processed_date"), *rest)


def latest_snapshot(spark: SparkSession, path: str) -> tuple[int, dict[str, Any]]:
    """Number and manifest of the newest snapshot of a log: its folder and the log files it covers; 0 without one."""
    names = [name for name, _ in list_files(spark, f"{path}/{SNAPSHOTS}") if name.endswith(".json")]
    if not names:
        return 0, {}
    return int(max(names).removesuffix(".json")), json.loads(read_text(spark, f"{path}/{SNAPSHOTS}/{max(names)}"))


def checkpoint_files(spark: SparkSession, path: str, snapshot: dict[str, Any]) -> list[str]:
    """The log's files that a snapshot does not cover."""
    covered = set(snapshot.get("covers", ()))
    return [name for name, _ in list_files(spark, path) if name not in covered]


def _log(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """All records, or with a snapshot its records and those appended since."""
    _, snapshot = latest_snapshot(spark, path)
    reader = spark.read.schema(schema)
    if not snapshot:
        return reader.json(path, multiLine=multi_line)
    later = [f"{path}/{name}" for name in checkpoint_files(spark, path, snapshot)]
    parts = [reader.json(f"{path}/{snapshot['folder']}")]
    return reduce(DataFrame.unionAll, [*parts, reader.json(later, multiLine=multi_line)] if later else parts)


def snapshot_records(spark: SparkSession, path: str) -> DataFrame:
    """The records from which :func:`latest_checkpoints` finds the same as from the whole log."""
    log = _log(spark, path, CHECKPOINT_SCHEMA)
    order = F.struct("updated_at", "last_processed_date", "execution_id")
    record = F.struct(*CHECKPOINT_SCHEMA.names)
    newest = log.groupBy("job_name").agg(
        F.max_by(record, order).alias("newest"), F.max_by(record, F.when(F.col("status") == "success", order)).alias("succeeded")
    )
    kept = F.array_distinct(F.array_compact(F.array("newest", "succeeded")))
    return newest.select(F.inline(kept))


def read_checkpoint(
    spark: SparkSession,
    path: str,
    job_name: str | None = None,
    single_document: bool = False,
    schema: T.StructType = CHECKPOINT_SCHEMA,
) -> DataFrame:
    """Newest record of one job or of all; no rows when there is none.

    ``single_document`` reads files that each hold one indented JSON object.
    A log with snapshots is read from the newest and what was appended since.
    ``schema`` is the layout of the records. One that lacks fields of the usual layout
    says nothing of jobs and order, so all its documents come back as they are.
    """
    usual = set(CHECKPOINT_SCHEMA.names) <= set(schema.names)
    if job_name is not None and "job_name" not in schema.names:
        raise ValueError("records without job_name can't be chosen by it")
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    log = _log(spark, path, schema, single_document)
    if job_name is not None:
        log = log.where(F.col("job_name") == job_name)
    return latest_checkpoints(log) if usual else log


def read_run_summaries(spark: SparkSession, path: str, job_name: str | None = None) -> DataFrame:
    """Records of runs with their declared layout, of one job or of all.

    A run that died before its checkpoint moved is repeated and recorded again: of the
    records of a job and window the newest counts.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_SUMMARY_SCHEMA)
    log = spark.read.schema(RUN_SUMMARY_SCHEMA).json(path)
    log = log if job_name is None else log.where(F.col("job_name") == job_name)
    order = F.struct("updated_at", *[c for c in log.columns if c != "updated_at"])
    newest = log.groupBy("job_name", "start_date", "end_date").agg(F.max(order).alias("_record"))
    return newest.select(*[f"_record.{c}" for c in RUN_SUMMARY_SCHEMA.names])
