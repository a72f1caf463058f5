"""Dropping expired days of a stored table, by metadata alone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from ..schemas import EXPIRE_AFTER_DAYS
from ..session import list_files
from ..versions import Change, Version, commit, latest_version

_REPORT = "dt string, age_days int, files long, bytes long"


def _oldest_kept(as_of: date, expire_after: int) -> str:
    return (as_of - timedelta(days=expire_after - 1)).isoformat()


def expired_days(spark: SparkSession, path: str, as_of: date, expire_after: int = EXPIRE_AFTER_DAYS) -> DataFrame:
    """(dt, age_days, files, bytes): what :func:`expire_days` would drop. Nothing is changed, no row is read."""
    found = []
    for day, folders in latest_version(spark, path).folders().items():
        if day < _oldest_kept(as_of, expire_after):
            sizes = [size for folder in folders for _, size in list_files(spark, f"{path}/{folder}")]
            found.append((day, (as_of - date.fromisoformat(day)).days, len(sizes), sum(sizes)))
    return spark.createDataFrame(found, _REPORT)


def expire_days(
    spark: SparkSession, path: str, as_of: date, expire_after: int = EXPIRE_AFTER_DAYS, name: str | None = None
) -> Version:
    """Drops days of that age or more from a table, and from its catalog entry ``name``.

    One commit leaves them out; readers of the version before go on, as files stay until
    :func:`fieldgauge.versions.remove_unused` finds them old enough. Then their catalog
    partitions go. A run that dies in between is repeated; a repeat changes nothing.
    """
    oldest = _oldest_kept(as_of, expire_after)
    version = latest_version(spark, path)
    days = sorted(day for day in version.folders() if day < oldest)
    if days:
        version = commit(spark, path, [Change(None, days)])
    if name:
        held = [row.partition.removeprefix("dt=") for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        gone = ", ".join(f"PARTITION (dt = '{day}')" for day in held if day < oldest)
        if gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    return version
