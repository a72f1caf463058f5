"""Date tokens and ISO day strings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted tokens and the days they lie before the reference day.
RELATIVE_DAYS = {"yesterday": 1, "today": 0, "last_week": 7}


def iso_day(value: Column | str) -> Column:
    """ISO text of a date or timestamp; casts, which are faster than a format pattern."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("date").cast("string")


def resolve_date(token: Column | str, as_of: Column | str | date) -> Column:
    """Date meant by a token: a relative word or an ISO day; null if neither.

    Case and surrounding white space do not matter. ``as_of`` is explicit so that a
    rerun of the same input gives the same dates.
    """
    token = F.col(token) if isinstance(token, str) else token
    if isinstance(as_of, date):
        as_of = F.lit(as_of)
    elif isinstance(as_of, str):
        as_of = F.col(as_of)
    word = F.lower(F.regexp_replace(token, r"^\s+|\s+$", ""))
    resolved = F.when(word.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(word, "yyyy-MM-dd"))
    for name, days in RELATIVE_DAYS.items():
        resolved = resolved.when(word == name, F.date_sub(as_of, days))
    return resolved
