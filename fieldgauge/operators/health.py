"""Health-check results and their daily history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fx
from .. import schemas as S

RANGES_PER_E = 64
PIECES = 4096
LAST_RANGE = 10**6  # above the range of any number


def health_results(df: DataFrame, job_name: str, execution_id: Column | str = "manual") -> DataFrame:
    """Health-check records from logged probes.

    Needs ``http_status, latency_ms, timestamp, rate_limit_remaining,
    rate_limit_limit, cause``. A probe with no HTTP status failed before a
    response; its record has an error class instead of status and latency.
    """
    responded = F.col("http_status").isNotNull()
    execution_id = F.lit(execution_id) if isinstance(execution_id, str) else execution_id
    return df.select(
        fx.health_status("http_status").alias("status"),
        F.col("http_status").cast("int").alias("http_status"),
        F.when(responded, F.round("latency_ms", 2)).alias("latency_ms"),
        "timestamp",
        F.when(responded, F.col("rate_limit_remaining").cast("string")).alias("rate_limit_remaining"),
        F.when(responded, F.col("rate_limit_limit").cast("string")).alias("rate_limit_limit"),
        fx.failure_class("http_status", "cause").alias("error"),
        F.when(~responded, F.col("cause")).alias("error_message"),
        F.lit(job_name).alias("job_name"),
        execution_id.alias("execution_id"),
    )


def health_daily_summary(history: DataFrame, alert_share: float = S.FAILURE_ALERT_SHARE) -> DataFrame:
    """Checks, success rate, latency and failure classes per day.

    ``is_alert`` marks days on which more than ``alert_share`` of checks failed.
    """
    checks = F.count("*")
    failed = F.count_if(F.col("status") != "success")
    # Summed as decimals, so the result does not depend on the order of rows.
    total_latency = F.sum(F.col("latency_ms").cast("decimal(18,2)"))
    return history.groupBy("day").agg(
        checks.alias("checks"),
        F.count_if(F.col("status") == "success").alias("successes"),
        (F.count_if(F.col("status") == "success").cast("double") / checks).alias("success_rate"),
        F.try_divide(total_latency.cast("double"), F.count("latency_ms")).alias("avg_latency_ms"),
        F.count_if(F.col("error") == "timeout").alias("timeouts"),
        F.count_if(F.col("error") == "connection_error").alias("connection_errors"),
        F.count_if(F.col("error") == "unexpected_error").alias("unexpected_errors"),
        F.count_if(fx.is_high_latency("latency_ms")).alias("high_latency_checks"),
        (failed.cast("double") / checks > alert_share).alias("is_alert"),
    )


def failure_alerts(history: DataFrame, alert_share: float = S.FAILURE_ALERT_SHARE) -> DataFrame:
    return health_daily_summary(history, alert_share).where("is_alert")


def _value_range(value: Column) -> Column:
    """Number of the range a value lies in: 64 for each power of e, ascending, NaN last."""
    size = F.floor(F.least(F.log1p(F.abs(value)) * RANGES_PER_E, F.lit(LAST_RANGE - 1.0)))
    ascending = F.when(value < 0, -size).otherwise(size)
    return F.when(F.isnan(value), F.lit(LAST_RANGE)).otherwise(ascending)


def _ranked_ranges(counts: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """Groups ``keys`` with their ranges in order of ``rank``: rows, rows before and at the end, bounds, rows of the group."""
    group = Window.partitionBy(*keys)
    running = F.sum("_size").over(group.orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranges = counts.groupBy(*keys, rank).agg(F.sum("_n").alias("_size"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    return ranges.withColumn("_end", running).withColumn("_before", F.col("_end") - F.col("_size"))


def latency_percentiles(
    df: DataFrame,
    by: Sequence[str] = ("day",),
    percents: Sequence[int] = (50, 95, 99),
    latency: str = "latency_ms",
) -> DataFrame:
    """Exact interpolated percentiles of latency, one ``p<percent>`` column each.

    Rows are first counted per distinct latency (combined before the shuffle), and
    those counts per range of latencies, of which a group has some thousands at most.
    A running count over the ranges finds those that hold a wanted rank. These are cut once
    more, into PIECES of equal width between their own least and greatest latency, and
    again only the pieces that hold a rank go on; their latencies alone are ordered, one
    piece to a task. So latencies crowded into one range do not meet in one task. Nothing
    is rounded.
    """
    counts = (
        df.where(F.col(latency).isNotNull())
        .groupBy(*by, F.col(latency).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_range", _value_range(F.col("_value")))
    )
    names = {c: f"_by{i}" for i, c in enumerate(by)}
    ranges = _ranked_ranges(counts, by, "_range").withColumn("_total", F.sum("_size").over(Window.partitionBy(*by)))

    def ranks(percent: int) -> tuple[Column, Column, Column]:
        # Whole-number arithmetic keeps the rank and its fraction exact.
        scaled = (F.col("_total") - 1) * F.lit(percent)
        return F.floor(scaled / 100), F.ceil(scaled / 100), scaled % 100

    wanted = [rank for p in percents for rank in ranks(p)[:2]]

    def holds(before: Column, end: Column) -> Column:
        return reduce(or_, [(before <= r) & (r < end) for r in wanted])

    def same(*more: Column) -> Column:
        return reduce(and_, [F.col(c).eqNullSafe(F.col(name)) for c, name in names.items()], reduce(and_, more))

    holding = ranges.where(holds(F.col("_before"), F.col("_end"))).select(
        *[F.col(c).alias(name) for c, name in names.items()], F.col("_range").alias("_at"), "_before", "_low", "_high", "_total"
    )
    # Infinite bounds, and a range of one latency, give no width: one piece.
    width = (F.col("_high") - F.col("_low")) / PIECES
    piece = F.floor((F.col("_value") - F.col("_low")) / width)
    usable = (width > 0) & (width < float("inf")) & ~F.isnan("_value")
    cut = counts.join(holding, same(F.col("_range") == F.col("_at"))).withColumn(
        "_piece", F.when(usable, F.least(piece, F.lit(PIECES - 1))).otherwise(0)
    )
    inner = cut.select(*by, "_range", "_piece", "_value", "_n", F.col("_before").alias("_base"), "_total")
    pieces = _ranked_ranges(inner, [*by, "_range", "_base", "_total"], "_piece")
    chosen = pieces.where(holds(F.col("_base") + F.col("_before"), F.col("_base") + F.col("_end"))).select(
        *[F.col(c).alias(name) for c, name in names.items()],
        F.col("_range").alias("_at"),
        F.col("_piece").alias("_part"),
        (F.col("_base") + F.col("_before")).alias("_until"),
    )
    inside = Window.partitionBy(*by, "_range", "_piece").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = inner.join(chosen, same(F.col("_range") == F.col("_at"), F.col("_piece") == F.col("_part")))
    ranked = found.withColumn("_upto", F.col("_until") + F.sum("_n").over(inside))

    def value_at(rank: Column) -> Column:
        here = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
        return F.max(F.when(here, F.col("_value")))

    def percentile(percent: int) -> Column:
        lower, upper, share = ranks(percent)
        low, high = value_at(lower), value_at(upper)
        between = F.when(low == high, low).otherwise(low + (high - low) * (F.max(share) / 100))
        return between.alias(f"p{percent}")

    return ranked.groupBy(*by).agg(F.max("_total").alias("checks"), *[percentile(p) for p in percents])
