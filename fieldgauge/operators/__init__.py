"""DataFrame to DataFrame operators."""

from .dedup import latest_per_key
from .gaps import expected_vs_actual, missing_in_range, missing_observations, missing_ranges, not_stored
from .health import failure_alerts, health_daily_summary, health_results, latency_percentiles
from .maintenance import (
    footer_drift,
    live_rows,
    partition_skew,
    retention_tier,
    schema_drift,
    stale_checkpoints,
    value_range_report,
)
from .pages import cursor_chain_audit, page_chain_audit
from .presence import absent_sensors, distinct_present, missing_counts, presence_bitmaps, sensor_ordinal
from .quality import quality_metrics, run_summary
from .regions import region_aggregates
from .requests import request_metrics, with_request_flags
from .sketches import RANK_ERROR, latency_sketches, merged_percentiles
from .transform import classified, transform

__all__ = [
    "RANK_ERROR",
    "absent_sensors",
    "classified",
    "cursor_chain_audit",
    "distinct_present",
    "expected_vs_actual",
    "failure_alerts",
    "footer_drift",
    "health_daily_summary",
    "health_results",
    "latency_percentiles",
    "latency_sketches",
    "latest_per_key",
    "live_rows",
    "merged_percentiles",
    "missing_counts",
    "missing_in_range",
    "missing_observations",
    "missing_ranges",
    "not_stored",
    "page_chain_audit",
    "partition_skew",
    "presence_bitmaps",
    "quality_metrics",
    "region_aggregates",
    "request_metrics",
    "retention_tier",
    "run_summary",
    "schema_drift",
    "sensor_ordinal",
    "stale_checkpoints",
    "transform",
    "value_range_report",
    "with_request_flags",
]
