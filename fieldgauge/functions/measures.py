"""Derived measures, bands and quality flags of one observation row.

Arguments are columns or column names; a name with odd characters needs backquotes, as
everywhere in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

HIGH, LOW, RAIN = S.MEASURES


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_fahrenheit(celsius: Column | str) -> Column:
    return as_column(celsius) * 9.0 / 5.0 + 32.0


def temperature_range(high: Column | str = HIGH, low: Column | str = LOW) -> Column:
    return as_column(high) - as_column(low)


def temperature_avg(high: Column | str = HIGH, low: Column | str = LOW) -> Column:
    return (as_column(high) + as_column(low)) / 2.0


def banded(value: Column | str, bands: Sequence[tuple[float, str]], top: str | None) -> Column:
    """Label of the first band whose upper edge lies above ``value``.

    Bands are (exclusive upper edge, label) in ascending order. A null value is
    below no edge and so gets ``top``.
    """
    value, label = as_column(value), F
    for edge, name in bands:
        label = label.when(value < float(edge), F.lit(name))
    return F.lit(top) if label is F else label.otherwise(F.lit(top))


def temperature_category(
    avg: Column | str = "temperature_avg", null_label: str | None = S.TEMPERATURE_TOP_BAND
) -> Column:
    """Temperature band of the daily average.

    By default a missing average is labelled as the top band, as existing
    consumers expect; pass another ``null_label`` (or None) to tell it apart.
    """
    bands = banded(avg, S.TEMPERATURE_BANDS, S.TEMPERATURE_TOP_BAND)
    if null_label == S.TEMPERATURE_TOP_BAND:
        return bands
    return F.when(as_column(avg).isNull(), F.lit(null_label).cast("string")).otherwise(bands)


def precipitation_level(amount: Column | str = RAIN) -> Column:
    amount = as_column(amount)
    return (
        F.when(amount.isNull(), F.lit(S.PRECIPITATION_MISSING))
        .when(amount == 0.0, F.lit(S.PRECIPITATION_ZERO))
        .otherwise(banded(amount, S.PRECIPITATION_BANDS, S.PRECIPITATION_TOP_BAND))
    )


def is_complete() -> Column:
    """True when no measure is null; never null itself."""
    return reduce(and_, [F.col(m).isNotNull() for m in S.MEASURES])


def quality_score(complete: Column | str | None = None, avg: Column | str = "temperature_avg") -> Column:
    """Score of a row; ``complete`` is the completeness of its measures unless given."""
    complete = is_complete() if complete is None else as_column(complete)
    return (
        F.when(complete, F.lit(S.SCORE_COMPLETE))
        .when(as_column(avg).isNotNull(), F.lit(S.SCORE_TEMPERATURE_ONLY))
        .otherwise(F.lit(S.SCORE_NO_TEMPERATURE))
    )


def default_fill(value: Column | str, default: str) -> Column:
    """``default`` where the text is null or empty."""
    return F.coalesce(F.nullif(as_column(value), F.lit("")), F.lit(default))
