"""What of a run's result may be shown: known keys, none that speaks of a secret."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys that may be shown, and words that no shown key contains.
SHOWN = (
    "action", "archive_path", "archive_size_bytes", "attachment_backlog", "attachment_expected_bytes", "attachment_expected_count", "attachment_documented_variance_bytes", "attachment_documented_variance_count",
    "attachment_documented_variance_files", "attachment_retried_count", "attachment_accepted_variance_count", "attachment_accepted_variance_bytes", "attachment_accepted_variance_files", "attachment_missing_count",
    "attachment_present_bytes", "attachment_present_count", "attachment_size_mismatch_count", "attachment_skipped_count", "attachment_snippet_variance_bytes", "attachment_snippet_variance_count", "attachment_unsafe_count",
    "canonical_latest_message_at", "channel_count", "duration_seconds", "file_count", "lock_wait_seconds", "message_count", "mode", "rows_deleted", "rows_inserted", "rows_updated", "row_count",
    "source_latest_message_at", "table_count", "warehouse_path", "workspace_id", "metrics_pushed",
)
SECRET_WORDS = ("cookie", "password", "secret", "token")


def shown(result: Column) -> Column:
    """A map (string to string) with the keys that may be shown; null values are left out."""
    return F.map_filter(result, lambda k, v: k.isin(*SHOWN) & ~F.lower(k).rlike("|".join(SECRET_WORDS)) & v.isNotNull())
