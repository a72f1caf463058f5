"""Raw observations to the analytics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import PROCESSING_VERSION, TRANSFORMED_SCHEMA
from .dedup import latest_per_key
from .regions import region_aggregates


def classified(df: DataFrame) -> DataFrame:
    """Add conversions, derived measures, bands, completeness and score.

    Two projections; Catalyst collapses them into the scan's codegen stage.
    """
    derived = df.select(
        "*",
        fx.to_fahrenheit("temperature_max").alias("temperature_max_f"),
        fx.to_fahrenheit("temperature_min").alias("temperature_min_f"),
        fx.temperature_range().alias("temperature_range"),
        fx.temperature_avg().alias("temperature_avg"),
    )
    return derived.select(
        "*",
        fx.temperature_category().alias("temp_category"),
        fx.precipitation_level().alias("precipitation_level"),
        fx.is_complete().alias("is_complete"),
        fx.quality_score().alias("data_quality_score"),
    )


def transform(
    df: DataFrame,
    tie_break: Sequence[str] = (),
    processed_at: Column | None = None,
) -> DataFrame:
    """Deduplicate, derive and classify, then attach regional aggregates.

    Deduplication comes first: it needs raw columns only, and everything after it
    then handles fewer rows. Regional aggregates see one row per sensor and day.
    Columns beyond the observation layout, such as ``tie_break``, come last.
    The aggregates and the rows they are joined to read one deduplication shuffle.
    """
    stamp = F.current_timestamp() if processed_at is None else processed_at
    latest = latest_per_key(df, tie_break=tie_break)
    labelled = classified(latest).select(
        "*", stamp.alias("processed_at"), F.lit(PROCESSING_VERSION).alias("processing_version")
    )
    full = region_aggregates(labelled)
    extra = [c for c in df.columns if c not in TRANSFORMED_SCHEMA.names]
    return full.select(*TRANSFORMED_SCHEMA.names, *extra)
