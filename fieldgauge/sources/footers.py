"""What stored Parquet files say of themselves, without reading any of their rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..versions import ROWS, latest_version

FOOTER_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("nulls", T.LongType()),
    ]
)

# Arrow's names for what Spark's writer stores under others.
_TYPES = {"large_string": "string", "int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint"}
_TYPES |= {"bool": "boolean", "date32[day]": "date"}


def _type_name(kind: pa.DataType, stored: str) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz or stored == "INT96" else "timestamp_ntz"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return _TYPES.get(str(kind), str(kind))


def _describe(path: str) -> list[dict]:
    """A row for each column of a file; a file without columns has one without a name."""
    # Executors open files by the store's own scheme; Hadoop's s3a is S3.
    store, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with store.open_input_file(name) as stream, pq.ParquetFile(stream) as file:
        rows, schema = file.metadata.num_rows, file.schema_arrow
        leaves = (file.metadata.schema.column(i) for i in range(len(file.metadata.schema)))
        stored = {leaf.path: leaf.physical_type for leaf in leaves}
        nulls: dict[str, int | None] = dict.fromkeys(schema.names, 0)
        for group in range(file.metadata.num_row_groups):
            part = file.metadata.row_group(group)
            for index in range(part.num_columns):
                column = part.column(index)
                top, _, nested = column.path_in_schema.partition(".")
                known = column.statistics is not None and column.statistics.has_null_count and not nested
                nulls[top] = nulls[top] + column.statistics.null_count if known and nulls.get(top) is not None else None
    found = [
        {"file": path, "rows": rows, "column_name": f.name, "type": _type_name(f.type, stored.get(f.name, "")), "nulls": nulls[f.name]}
        for f in schema
    ]
    return found or [{"file": path, "rows": rows, "column_name": None, "type": None, "nulls": None}]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layout = pa.schema([("file", pa.string()), ("rows", pa.int64()), ("column_name", pa.string())])
    layout = layout.append(pa.field("type", pa.string())).append(pa.field("nulls", pa.int64()))
    for batch in batches:
        rows = [row for path in batch.column("path").to_pylist() for row in _describe(path)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=layout)


def read_footers(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, rows, column_name, type, nulls) for every column of every Parquet file under the paths.

    Files are listed and their footers read by tasks; contents are not opened. ``nulls`` is
    null where a file has no statistics, and for nested columns. Files must lie where
    executors can open them: a mounted or local folder, S3, GCS or HDFS.
    """
    if not paths:
        return spark.createDataFrame([], FOOTER_SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    # The content column is not selected, so it is not read.
    return files.load(list(paths)).select("path").mapInArrow(_read, FOOTER_SCHEMA)


def table_footers(spark: SparkSession, path: str, days: Sequence[str] | None = None, part: str = ROWS) -> DataFrame:
    """The footers of a stored table's newest version, or of some of its days, with the day as ``dt``."""
    folders = latest_version(spark, path).folders(part)
    chosen = [f"{path}/{f}" for day, of_day in folders.items() if days is None or day in days for f in of_day]
    return read_footers(spark, *chosen).withColumn("dt", F.regexp_extract("file", r"/dt=([^/]*)/", 1))
