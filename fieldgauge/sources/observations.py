"""Landed observation files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import OBSERVATION_SCHEMA, REQUIRED_FIELDS


def drop_incomplete_records(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Rows with every required field present.

    File sources ignore non-null flags, so the layout is enforced here; the null
    tests are pushed to the scan.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


def has_day(day: Column | str = "dt") -> Column:
    """Whether a text is an ISO day of the calendar; false for null."""
    text = F.col(day) if isinstance(day, str) else day
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))


def rejected_observations(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """The rows that loading leaves out, with a ``reason``: a missing field by name, or ``invalid dt``."""
    reason = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required], F.when(~has_day(), F.lit("invalid dt"))
    )
    return df.withColumn("reason", reason).where("reason is not null")


def load_observations(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    schema: T.StructType = OBSERVATION_SCHEMA,
    rejects: bool = False,
) -> DataFrame:
    """Observations under ``path`` with the declared layout; nothing is inferred.

    Columns keep the declared order and types, day folders included. Rows without a
    required field, or whose day is not an ISO day, are left out; with
    ``rejects`` they are what is returned, each with its reason.
    """
    df = spark.read.schema(schema).format(file_format).load(path).select(*schema.names)
    required = [c for c in REQUIRED_FIELDS if c in schema.names]
    if rejects:
        return rejected_observations(df, required)
    return drop_incomplete_records(df, required).where(has_day())
