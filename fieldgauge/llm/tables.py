"""Tables written to the shared folder, which cut a job's lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldgauge.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written to the folder named by spark.checkpoint.dir and read again."""
    path = f"{scratch_path(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
