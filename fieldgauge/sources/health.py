"""History of health checks kept in dated folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import HEALTH_SCHEMA
from ..session import list_folders


def read_health_history(spark: SparkSession, root: str, single_document: bool = False) -> DataFrame:
    """All check results below ``root`` with the ``day`` of their folder.

    Folders named ``day=YYYY-MM-DD`` are read as partitions, so a filter on ``day``
    lists and reads only those it needs. Where any folder is named otherwise, all are
    read, and the day is the date that ends the name of a file's folder.
    ``single_document`` reads files that each hold one indented JSON object.
    """
    folders = [f for f in list_folders(spark, root) if not f.startswith(("_", "."))]
    if folders and all(f.startswith("day=") for f in folders):
        layout = T.StructType([*HEALTH_SCHEMA.fields, T.StructField("day", T.StringType())])
        return spark.read.schema(layout).json(root, multiLine=single_document).select("day", *HEALTH_SCHEMA.names)
    df = spark.read.schema(HEALTH_SCHEMA).json(root, multiLine=single_document, recursiveFileLookup=True)
    folder = F.regexp_extract("_metadata.file_path", r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
    return df.select(folder.alias("day"), *HEALTH_SCHEMA.names)
