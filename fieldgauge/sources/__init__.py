"""Typed readers."""

from .checkpoints import latest_checkpoints, read_checkpoint, read_run_summaries
from .footers import read_footers, table_footers
from .health import read_health_history
from .observations import drop_incomplete_records, has_day, load_observations, rejected_observations
from .payload import parse_daily_payload, unreadable_payloads
from .tables import discover_partitions, read_merged, read_table, read_version, recent_readings, register_table, sync_partitions

__all__ = [
    "discover_partitions",
    "drop_incomplete_records",
    "has_day",
    "latest_checkpoints",
    "load_observations",
    "parse_daily_payload",
    "read_checkpoint",
    "read_footers",
    "read_health_history",
    "read_merged",
    "read_run_summaries",
    "read_table",
    "read_version",
    "recent_readings",
    "register_table",
    "rejected_observations",
    "sync_partitions",
    "table_footers",
    "unreadable_payloads",
]
