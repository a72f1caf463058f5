"""Retention, skew, drift, staleness and range reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def retention_tier(
    df: DataFrame,
    as_of: date,
    day: str = "dt",
    cold_after: int = S.COLD_AFTER_DAYS,
    expire_after: int = S.EXPIRE_AFTER_DAYS,
) -> DataFrame:
    """Add ``age_days`` and ``tier``: hot, cold or expired."""
    age = F.datediff(F.lit(as_of), F.to_date(day))
    return df.select(
        "*",
        age.alias("age_days"),
        F.when(age >= expire_after, F.lit("expired"))
        .when(age >= cold_after, F.lit("cold"))
        .otherwise(F.lit("hot"))
        .alias("tier"),
    )


def live_rows(df: DataFrame, as_of: date, day: str = "dt", expire_after: int = S.EXPIRE_AFTER_DAYS) -> DataFrame:
    """Rows not yet expired, as a plain comparison that prunes day partitions."""
    oldest = date.fromordinal(as_of.toordinal() - expire_after + 1)
    return df.where(F.col(day) >= F.lit(oldest.isoformat()))


def partition_skew(df: DataFrame, by: str = "dt", factor: float = 2.0) -> DataFrame:
    """Rows per partition value and their ratio to the mean over all values."""
    counts = df.groupBy(by).agg(F.count("*").alias("row_count"))
    totals = counts.agg(F.sum("row_count").alias("s"), F.count("*").alias("c"))
    mean = totals.select(F.col("s").cast("double") / F.col("c")).scalar()
    ratio = F.col("row_count") / mean
    return counts.select(by, "row_count", ratio.alias("ratio_to_mean"), (ratio > factor).alias("is_skewed"))


def schema_drift(
    df: DataFrame, expected: T.StructType = S.OBSERVATION_SCHEMA, by: Sequence[str] = ()
) -> DataFrame:
    """Expected against actual columns, with how many rows carry each.

    ``status`` is ok, type_changed, missing or unexpected. Nothing is changed;
    one pass counts all columns. With ``by``, such as the day of a stored table read
    by its merged layout, rows are counted per group, next to its ``row_count``: a
    column without any value in a group is ``no_values`` there. Whether the group's files
    lack the column, or hold it with another type, only their footers tell
    (:func:`footer_drift`).
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in by}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields if f.name not in by}
    names = [*wanted, *(c for c in actual if c not in wanted)]

    def entry(name: str) -> Column:
        if name not in actual:
            status = "missing"
        elif name not in wanted:
            status = "unexpected"
        else:
            status = "ok" if actual[name] == wanted[name] else "type_changed"
        rows = F.col(f"`{name}`") if name in actual else F.lit(0).cast("bigint")
        found = F.lit(status)
        if by and name in actual:
            found = F.when(rows == 0, F.lit("no_values")).otherwise(found)
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(wanted.get(name)).cast("string").alias("expected_type"),
            F.lit(actual.get(name)).cast("string").alias("actual_type"),
            found.alias("status"),
            rows.alias("rows_with_value"),
        )

    total = [F.count("*").alias("row_count")] if by else []
    counted = df.groupBy(*by).agg(*total, *[F.count(f"`{c}`").alias(c) for c in actual])
    keys = [*by, "row_count"] if by else []
    return counted.select(*keys, F.inline(F.array(*[entry(n) for n in names])))


def footer_drift(
    footers: DataFrame, expected: T.StructType = S.OBSERVATION_SCHEMA, by: Sequence[str] = ("dt",)
) -> DataFrame:
    """Expected columns against those that stored files have, from their footers (no row is read).

    For each group, such as a day, one row for each expected and each further column.
    ``files`` of the group's files ``files_with_column`` have it, ``types`` are the types
    they hold it with, and ``rows_with_value`` counts its values (null if a file does not
    say). ``status`` is ``absent`` if no file has it, ``partly_absent`` if some lack it,
    ``type_changed`` if a file holds another type, ``all_null`` if all have it but no value,
    ``unexpected`` for further columns, and else ``ok``. Files without rows say nothing and
    are left out. Columns of ``by`` are folders, not file columns.
    """
    keys = list(by)
    wanted = [f for f in expected.fields if f.name not in keys]
    spoken = footers.where("rows > 0")
    files = spoken.groupBy(*keys).agg(
        F.countDistinct("file").alias("files"),
        F.array_sort(F.collect_set("column_name")).alias("_held"),
    )
    counted = spoken.where("column_name is not null").groupBy(*keys, "column_name")
    held = counted.agg(
        F.count("*").alias("files_with_column"),
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"),
        F.when(F.count("nulls") == F.count("*"), F.sum(F.col("rows") - F.col("nulls"))).alias("rows_with_value"),
    )
    names = F.array_union(F.array(*[F.lit(f.name) for f in wanted]), "_held")
    asked = files.select(*keys, "files", F.explode(names).alias("column_name"))
    kinds = F.create_map(*[F.lit(x) for f in wanted for x in (f.name, f.dataType.simpleString())])
    joined = asked.join(held, [*keys, "column_name"], "left").withColumn("expected_type", F.try_element_at(kinds, F.col("column_name")))
    with_column = F.coalesce("files_with_column", F.lit(0))
    status = (
        F.when(F.col("expected_type").isNull(), "unexpected")
        .when(with_column == 0, "absent")
        .when(F.col("types") != F.col("expected_type"), "type_changed")
        .when(with_column < F.col("files"), "partly_absent")
        .when(F.col("rows_with_value") == 0, "all_null")
        .otherwise("ok")
    )
    values = F.when(with_column == 0, F.lit(0)).otherwise(F.col("rows_with_value"))
    return joined.select(
        *keys, "column_name", "expected_type", "types", "files", with_column.alias("files_with_column"),
        values.cast("long").alias("rows_with_value"), status.alias("status"),
    )


def stale_checkpoints(latest: DataFrame, as_of: Column, hours: int = S.STALE_AFTER_HOURS) -> DataFrame:
    """Age of each job's checkpoint and whether it is older than ``hours``."""
    seconds = F.unix_timestamp(as_of) - F.unix_timestamp(F.to_timestamp("updated_at"))
    return latest.select(
        "job_name",
        "last_processed_date",
        "updated_at",
        (seconds / 3600).alias("age_hours"),
        (seconds > hours * 3600).alias("is_stale"),
    )


def value_range_report(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per column: values below, above and within an inclusive range, and nulls."""
    counted = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count_if(F.col(name) < low).alias("below"),
                F.count_if(F.col(name) > high).alias("above"),
                F.count_if(F.col(name).between(low, high)).alias("within"),
                F.count_if(F.col(name).isNull()).alias("nulls"),
            ).alias(name)
            for name, (low, high) in ranges.items()
        ]
    )
    return counted.select(F.inline(F.array(*ranges)))
