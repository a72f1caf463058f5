"""Newest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import OBSERVATION_KEYS


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = OBSERVATION_KEYS,
    order_by: str = "ingestion_timestamp",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, then ``tie_break``.

    The greatest struct is combined before the shuffle, so each map task sends at
    most one row per key however many rows a hot key has. Keys stay plain grouping
    columns, so a filter on them above this operator still reaches the scan.
    Consumers that need different columns share one shuffle, since the row travels
    as one struct.

    Equally new rows are told apart by their remaining values, so a rerun keeps the
    same one. Nulls count as oldest.
    """
    order = [c for c in dict.fromkeys([order_by, *tie_break]) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)
