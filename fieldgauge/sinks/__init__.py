"""Writers."""

from .expiry import expire_days, expired_days
from .logs import (
    append_checkpoint,
    append_health_results,
    append_layout_changes,
    append_run_summary,
    checkpoint_record,
    compact_checkpoints,
    remove_covered,
)
from .observations import (
    compact_days,
    file_plan,
    overwrite_days,
    read_rejects,
    sized_for_write,
    upsert_days,
    write_observations,
)

__all__ = [
    "append_checkpoint",
    "append_health_results",
    "append_layout_changes",
    "append_run_summary",
    "checkpoint_record",
    "compact_checkpoints",
    "compact_days",
    "expire_days",
    "expired_days",
    "file_plan",
    "overwrite_days",
    "read_rejects",
    "remove_covered",
    "sized_for_write",
    "upsert_days",
    "write_observations",
]
