"""Day-partitioned Parquet tables and their catalog entries."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TRANSFORMED_SCHEMA
from ..versions import ROWS, Version, latest_version, read_version_record, version_numbers

VERSION_PROPERTY = "fieldgauge.version"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSFORMED_SCHEMA,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Stored table with its declared layout, of the inclusive day range if one is given.

    Declaring the layout keeps ``dt`` text and in place; a filter on it prunes day folders.
    A table with versions is read as of the newest one (see
    :mod:`fieldgauge.versions`), and of its folders only those of the range are listed.
    """
    version = latest_version(spark, path)
    if version.number:
        return read_version(spark, path, version, schema, since=since, until=until)
    table = spark.read.schema(schema).parquet(path).select(*schema.names)
    bounds = [F.col("dt") >= since] if since else []
    return reduce(DataFrame.where, [*bounds, *([F.col("dt") <= until] if until else [])], table)


def read_version(
    spark: SparkSession,
    path: str,
    version: Version,
    schema: T.StructType = TRANSFORMED_SCHEMA,
    part: str = ROWS,
    column: str = "dt",
    since: str | None = None,
    until: str | None = None,
    values: Collection[str] | None = None,
) -> DataFrame:
    """One part of a table as a version has it: the named folders and no others."""
    folders = [
        folder
        for value, of_value in version.folders(part).items()
        if (since is None or value >= since) and (until is None or value <= until) and (values is None or value in values)
        for folder in of_value
    ]
    # Days from before the first commit lie in the table's folder itself.
    plain = [f for f in folders if f.startswith(f"{column}=")]
    committed = [f for f in folders if not f.startswith(f"{column}=")]
    found = [
        spark.read.schema(schema).option("basePath", base).parquet(*(f"{path}/{f}" for f in group)).select(*schema.names)
        for base, group in ((path, plain), (f"{path}/{part}", committed))
        if group
    ]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Stored table with every column that any of its files has; types must agree."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType = TRANSFORMED_SCHEMA,
    partition_cols: tuple[str, ...] = ("dt",),
) -> None:
    """Declare files under ``path`` as an external table; known partitions: none yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_cols)
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET PARTITIONED BY ({parts}) LOCATION '{location}'"
    )


def discover_partitions(spark: SparkSession, name: str) -> None:
    """Add day folders written since the last discovery; the layout stays as declared."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def sync_partitions(spark: SparkSession, name: str, path: str) -> list[str]:
    """Brings a catalog entry to the newest version of its table; the days changed.

    What the commits since the last call have changed is all that is looked at: their
    manifests name the days and folders, and no folder is listed. The entry keeps the number
    of the version it is at. Where the manifests in between are gone, the entry's partitions
    are compared with the version's days instead. The layout stays as declared
    (:func:`fieldgauge.sinks.append_layout_changes` logs what differs).
    """
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    at = int(properties.get(VERSION_PROPERTY, -1))
    numbers = version_numbers(spark, path)
    newest = latest_version(spark, path)
    if at == newest.number:
        return []
    held = {row.partition.removeprefix("dt=") for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    days = {*held, *newest.folders()}
    since = [n for n in numbers if n > at]
    if at >= 0 and since == list(range(at + 1, newest.number + 1)):
        days = {day for n in since for day in read_version_record(spark, path, n).changed.get(ROWS, [])}
    split = [day for day in days if len(newest.folders().get(day, [])) > 1]
    if split:
        raise ValueError(f"a partition has one folder; compact these days first: {sorted(split)[:5]}")
    gone = sorted(day for day in days if day in held and day not in newest.folders())
    new = sorted(day for day in days if day not in held and day in newest.folders())
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(_partition(day) for day in gone)}")
    for day in sorted(days & held & newest.folders().keys()):
        spark.sql(f"ALTER TABLE {name} {_partition(day)} SET {_location(path, newest, day)}")
    if new:
        listed = " ".join(f"{_partition(day)} {_location(path, newest, day)}" for day in new)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {listed}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION_PROPERTY}' = '{newest.number}')")
    return sorted(days)


def _partition(day: str) -> str:
    return f"PARTITION (dt = '{day}')"


def _location(path: str, version: Version, day: str) -> str:
    folder = f"{path}/{version.folders()[day][0]}".replace("'", "\\'")
    return f"LOCATION '{folder}'"


def recent_readings(spark: SparkSession, name: str, since: str, limit: int = 100) -> DataFrame:
    """Newest readings of a registered table, as ``date`` for the day.

    The day comparison prunes partitions, and sort with limit keeps the top rows
    of each task only.
    """
    return spark.sql(
        f"""
        SELECT sensor_id, dt AS date, temperature_avg, temp_category, precipitation_level, data_quality_score
        FROM {name}
        WHERE dt >= :since
        ORDER BY date DESC, sensor_id
        LIMIT {int(limit)}
        """,
        args={"since": since},
    )
