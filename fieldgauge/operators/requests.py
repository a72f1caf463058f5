"""Metrics over a request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx


def with_request_flags(df: DataFrame) -> DataFrame:
    """Add outcome class, high-latency and low-allowance flags to each request."""
    return df.select(
        "*",
        fx.response_outcome("http_status").alias("outcome"),
        fx.is_high_latency("latency_ms").alias("is_high_latency"),
        fx.is_rate_limit_low("rate_limit_remaining", "rate_limit_limit").alias("is_rate_limit_low"),
    )


def request_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests by outcome, and the rate of errors.

    Errors are statuses of 400 and above, and requests without a status (timeouts,
    failed connections). Those turned away by a rate limit (429) or for want of a
    valid token (401) are repeated and counted apart. The rate is 0 when there are
    no requests.
    """
    total = F.count("*")
    outcome = fx.response_outcome("http_status")
    errors = F.count_if(outcome == "error")
    return df.groupBy(*by).agg(
        total.alias("request_count"),
        errors.alias("error_count"),
        F.when(total == 0, F.lit(0.0)).otherwise(errors.cast("double") / total).alias("error_rate"),
        F.count_if(outcome == "rate_limited").alias("rate_limited_count"),
        F.count_if(outcome == "auth").alias("auth_count"),
        F.count_if(fx.is_high_latency("latency_ms")).alias("high_latency_count"),
        F.count_if(fx.is_rate_limit_low("rate_limit_remaining", "rate_limit_limit")).alias("rate_limit_low_count"),
    )
