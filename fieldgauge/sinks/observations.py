"""Day-partitioned Parquet sink."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.transform import transform
from ..schemas import OBSERVATION_SCHEMA, ROWS_PER_FILE, TRANSFORMED_SCHEMA
from ..sources.tables import read_version
from ..versions import Change, Version, commit, latest_version, version_numbers

REJECTS, BATCH = "rejects", "batch"


def sized_for_write(df: DataFrame, partition_cols: Sequence[str] = ("dt",)) -> DataFrame:
    """Gather each day's rows into few files of the advisory size.

    A rebalance instead of a fixed hash partitioning: adaptive execution merges
    small days and splits a large one over several tasks, from the sizes of the
    shuffle itself and without counting rows first.
    """
    return df.hint("rebalance", *partition_cols)


def file_plan(df: DataFrame, rows_per_file: int = ROWS_PER_FILE, by: Sequence[str] = ("dt",)) -> DataFrame:
    """Rows and the number of files they fill: at least one, else whole multiples of ``rows_per_file``.

    Counted per day, or over everything with ``by=()``.
    """
    rows = F.count("*")
    return df.groupBy(*by).agg(
        rows.alias("row_count"),
        F.greatest(F.lit(1), F.floor(rows / F.lit(rows_per_file))).alias("target_files"),
    )


def write_observations(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_cols: Sequence[str] = ("dt",),
    rows_per_file: int | None = None,
    gather: bool = True,
) -> None:
    """Write Snappy Parquet in day folders.

    File size follows the adaptive advisory size; ``rows_per_file`` caps the rows
    of a file as well, without dropping any. ``gather=False`` skips the shuffle
    that brings a day's rows together, for rows that already lie that way. A table with
    versions takes rows by commits only (:func:`upsert_days`), so this refuses it.
    """
    if version_numbers(df.sparkSession, path):
        raise ValueError(f"{path} has versions; files written into it belong to none")
    sized = sized_for_write(df, partition_cols) if gather else df
    writer = sized.write.mode(mode).partitionBy(*partition_cols)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.option("partitionOverwriteMode", "static").option("compression", "snappy").parquet(path)


def overwrite_days(
    df: DataFrame, path: str, partition_cols: Sequence[str] = ("dt",), gather: bool = True
) -> None:
    """Replace the days present in ``df`` and leave all others; safe to repeat."""
    sized = sized_for_write(df, partition_cols) if gather else df
    writer = sized.write.mode("overwrite").partitionBy(*partition_cols)
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "snappy").parquet(path)


def _days_in(df: DataFrame) -> list[str]:
    # As many as there are day folders, which the file index lists on the driver anyway.
    return [row.dt for row in df.select("dt").distinct().collect()]


def upsert_days(
    batch: DataFrame,
    path: str,
    tie_break: Sequence[str] = (),
    rejects: DataFrame | None = None,
    writer: str | None = None,
    key: int | None = None,
    observe: Sequence[Column] = (),
) -> Version:
    """Merge observations into a stored table by one commit and return its version.

    Stored rows of the touched days join the batch before deduplication, so late
    records replace older ones and nothing already stored is lost; regional
    aggregates are recomputed over the whole day. Readers see all days as they were or
    all as they are (see :mod:`fieldgauge.versions`); a day that another writer commits in
    between is merged anew. ``rejects`` are published by the same commit, as what
    ``key`` turned away. Days must be ISO days; see
    :func:`fieldgauge.sources.rejected_observations`.
    """
    spark = batch.sparkSession
    extra = [f for f in batch.schema.fields if f.name not in TRANSFORMED_SCHEMA.names]
    stored_schema = T.StructType(TRANSFORMED_SCHEMA.fields + extra)
    days = _days_in(batch)
    odd = [day for day in days if not _is_day(day)]
    if odd:
        raise ValueError(f"days that are not ISO days: {odd[:5]}")
    raw = [*OBSERVATION_SCHEMA.names, *(f.name for f in extra)]

    def rows(base: Version) -> DataFrame:
        new = batch.select(*raw)
        if any(day in base.folders() for day in days):
            new = new.unionByName(read_version(spark, path, base, stored_schema, values=set(days)).select(*raw))
        return transform(new, tie_break=tie_break)

    changes = []
    if days:
        # Rows of a single day are together already, in tasks of the advisory size.
        changes.append(Change(rows, days, gather=len(days) > 1, observe=observe))
    if rejects is not None:
        turned_away = rejects.withColumn(BATCH, F.lit(key))
        changes.append(Change(lambda base: turned_away, part=REJECTS, column=BATCH))
    return commit(spark, path, changes, writer, key) if changes else latest_version(spark, path)


def read_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that commits to a table have turned away, with their ``reason`` and ``batch``."""
    layout = T.StructType([*schema.fields, T.StructField("reason", T.StringType()), T.StructField(BATCH, T.LongType())])
    return read_version(spark, path, latest_version(spark, path), layout, part=REJECTS, column=BATCH)


def _is_day(text: str | None) -> bool:
    try:
        return text is not None and date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def compact_days(
    spark: SparkSession, path: str, days: Sequence[str], schema: T.StructType = TRANSFORMED_SCHEMA
) -> Version:
    """Rewrite exactly the given days into few files of the advisory size, by one commit.

    A table without versions gets its first one. Its old files stay until
    :func:`fieldgauge.versions.remove_unused` finds them old enough.
    """
    stored = latest_version(spark, path)
    days = [day for day in dict.fromkeys(days) if day in stored.folders()]
    if not days:
        return stored
    return commit(spark, path, [Change(lambda base: read_version(spark, path, base, schema, values=set(days)), days)])
