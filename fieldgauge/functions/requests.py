"""Classification of logged requests and health checks; arguments are columns or column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from .measures import as_column


def health_status(http_status: Column | str) -> Column:
    """``success`` for HTTP 200 only; no status at all is a failure."""
    return F.when(as_column(http_status) == 200, F.lit("success")).otherwise(F.lit("failed"))


def failure_class(http_status: Column | str, cause: Column | str) -> Column:
    """Class of a check that got no response; null when there was one.

    ``cause`` is the logged cause: a text holding ``Timeout``, one starting with
    ``Connection``, or any other.
    """
    cause = as_column(cause)
    kind = (
        F.when(cause.ilike("%timeout%"), F.lit("timeout"))
        .when(cause.ilike("connection%"), F.lit("connection_error"))
        .otherwise(F.lit("unexpected_error"))
    )
    return F.when(as_column(http_status).isNull(), kind)


def is_high_latency(latency_ms: Column | str, threshold: float = S.HIGH_LATENCY_MS) -> Column:
    return F.coalesce(as_column(latency_ms) > float(threshold), F.lit(False))


def is_rate_limit_low(remaining: Column | str, limit: Column | str) -> Column:
    """Less than a tenth of the allowance left; false unless both numbers are known."""
    left, allowed = as_column(remaining).try_cast("bigint"), as_column(limit).try_cast("bigint")
    return F.coalesce(left < allowed * S.LOW_RATE_LIMIT_SHARE, F.lit(False))


def response_outcome(http_status: Column | str) -> Column:
    status = as_column(http_status)
    return (
        F.when(status == 429, F.lit("rate_limited"))
        .when(status == 401, F.lit("auth"))
        .when(status < 400, F.lit("ok"))
        .otherwise(F.lit("error"))
    )
