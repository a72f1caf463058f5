"""Incremental load of newly landed files."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import OBSERVATION_SCHEMA, PAYLOAD_REQUEST_SCHEMA, PAYLOAD_SOURCE
from ..session import read_text
from ..sinks.observations import upsert_days
from ..sources.observations import drop_incomplete_records, has_day, rejected_observations
from ..sources.payload import parse_daily_payload, unreadable_payloads


def incremental_stream(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    extra: T.StructType | None = None,
    tie_break: Sequence[str] = (),
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge observation files landed under ``source`` since the last run, then stop.

    Each micro-batch is one commit: its rows are merged into the stored days they touch, and
    those without a required field or an ISO day go to the table's rejects with a reason (see
    :func:`fieldgauge.sinks.read_rejects`). So each landed row counts in exactly one of both.
    A commit carries the number of its batch, and a batch that is replayed after a crash
    finds its own commit and changes nothing. ``bytes_per_batch`` or ``files_per_batch`` pace
    a first load, which otherwise takes the whole backlog at once; no file is left out. State
    is the file log only; it does not grow with the number of sensors.
    """
    schema = T.StructType(OBSERVATION_SCHEMA.fields + (extra.fields if extra else []))
    landed = _landed(spark, schema, files_per_batch, bytes_per_batch).parquet(source)

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        return drop_incomplete_records(batch).where(has_day()), rejected_observations(batch)

    return _merging(landed, split, table, checkpoint, tie_break)


def payload_stream(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    tie_break: Sequence[str] = (),
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    payload_source: str = PAYLOAD_SOURCE,
) -> StreamingQuery:
    """The same for landed JSON lines, each a request's columns with the response as ``payload``.

    A response that can't be read is rejected as a whole, with its text; of the others, each
    day is an observation that is merged or rejected.
    """
    landed = _landed(spark, PAYLOAD_REQUEST_SCHEMA, files_per_batch, bytes_per_batch).json(source)

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = parse_daily_payload(batch, source=payload_source)
        rejected = rejected_observations(rows).withColumn("payload", F.lit(None).cast("string"))
        return (
            drop_incomplete_records(rows).where(has_day()),
            rejected.unionByName(unreadable_payloads(batch, source=payload_source)),
        )

    return _merging(landed, split, table, checkpoint, tie_break)


def _landed(spark: SparkSession, schema: T.StructType, files: int | None, size: int | None):
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", size) if size else reader


def _merging(
    landed: DataFrame,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    table: str,
    checkpoint: str,
    tie_break: Sequence[str],
) -> StreamingQuery:
    log = f"{checkpoint}/log"

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The query's own id: a new checkpoint counts its batches anew.
        query = json.loads(read_text(batch.sparkSession, f"{log}/metadata"))["id"]
        rows, rejects = split(batch)
        upsert_days(rows, table, tie_break, rejects=rejects, writer=f"stream {query}", key=batch_id)

    return landed.writeStream.foreachBatch(merge).option("checkpointLocation", log).trigger(availableNow=True).start()
