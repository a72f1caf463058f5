"""Running sums over more rows than one task should sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, keys: list[str], bucket: str, order: list[Column | str], sums: dict[str, str]) -> DataFrame:
    """Adds for each (new column, summed column) the sum over the rows up to each row, itself included.

    Rows are ordered by ``bucket`` and then by ``order`` within each value of ``keys``.
    Only the rows of one bucket are sorted in one task; the sums of whole buckets are
    aggregated before the shuffle and joined back.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_before_{new}" for new in sums]
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(c).alias(n) for n, c in zip(names, sums.values(), strict=True)])
    for name in names:
        totals = totals.withColumn(name, F.coalesce(F.sum(name).over(before), F.lit(0)))
    for new, column in sums.items():
        df = df.withColumn(new, F.sum(column).over(inside))
    same = [df[c].eqNullSafe(totals[c]) for c in [*keys, bucket]]
    joined = df.join(totals, same)
    return joined.select(
        *[df[c] for c in df.columns if c not in sums],
        *[(df[new] + totals[f"_before_{new}"]).alias(new) for new in sums],
    )
