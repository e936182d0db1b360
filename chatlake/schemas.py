"""Schemas: archive tables, payload fields that are read, and the lake's tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The archive's tables with the columns that are read, and their types.
ARCHIVE_DDL = {
    "WORKSPACE": "ID bigint, CHUNK_ID bigint, LOAD_DTTM string, TEAM string, USERNAME string, TEAM_ID string, USER_ID string, ENTERPRISE_ID string, URL string, DATA binary",
    "CHANNEL": "ID string, CHUNK_ID bigint, LOAD_DTTM string, NAME string, IDX bigint, DATA binary",
    "S_USER": "ID string, CHUNK_ID bigint, LOAD_DTTM string, USERNAME string, IDX bigint, DATA binary",
    "CHANNEL_USER": "CHANNEL_ID string, USER_ID string, CHUNK_ID bigint, LOAD_DTTM string, IDX bigint",
    "MESSAGE": "ID bigint, CHUNK_ID bigint, LOAD_DTTM string, CHANNEL_ID string, TS string, PARENT_ID bigint, THREAD_TS string, LATEST_REPLY string, IS_PARENT bigint, IDX bigint, NUM_FILES bigint, TXT string, DATA binary",
    "FILE": "ID string, CHUNK_ID bigint, LOAD_DTTM string, CHANNEL_ID string, MESSAGE_ID bigint, THREAD_ID bigint, IDX bigint, MODE string, FILENAME string, URL string, SIZE bigint, DATA binary",
    "SESSION": "ID bigint, FINISHED bigint",
    "CHUNK": "ID bigint, SESSION_ID bigint, TYPE_ID bigint, FINAL bigint, CHANNEL_ID string, SEARCH_QUERY string, THREAD_ONLY bigint",
}
# Columns without which an archive is refused.
REQUIRED = {
    "WORKSPACE": ["CHUNK_ID", "TEAM", "TEAM_ID", "URL", "DATA"],
    "CHANNEL": ["ID", "CHUNK_ID", "NAME", "DATA"],
    "S_USER": ["ID", "CHUNK_ID", "USERNAME", "DATA"],
    "CHANNEL_USER": ["CHANNEL_ID", "USER_ID", "CHUNK_ID"],
    "MESSAGE": ["ID", "CHUNK_ID", "CHANNEL_ID", "TS", "THREAD_TS", "IS_PARENT", "TXT", "DATA"],
    "FILE": ["ID", "CHUNK_ID", "CHANNEL_ID", "MESSAGE_ID", "THREAD_ID", "DATA"],
    "SESSION": ["ID", "FINISHED"],
    "CHUNK": ["ID", "SESSION_ID", "TYPE_ID", "FINAL"],
}
NATURAL_KEYS = {"CHANNEL": ["ID"], "S_USER": ["ID"], "MESSAGE": ["CHANNEL_ID", "TS"], "FILE": ["ID"]}

_SEEN = "latest_run_id string, first_observed_at timestamp, last_observed_at timestamp"
# The lake's tables.
LAKE_DDL = {
    "ingestion_runs": "run_id string, workspace_id string, mode string, status string, started_at timestamp, completed_at timestamp, source_path string, source_fingerprint string, source_message_rows bigint, canonical_message_rows bigint, inserted_messages bigint, updated_messages bigint, unchanged_messages bigint, error_class string, error_message string",
    "source_archives": "workspace_id string, source_fingerprint string, source_path string, session_high_water bigint, chunk_high_water bigint, source_message_rows bigint, source_table_counts_json string, first_run_id string, latest_run_id string, first_ingested_at timestamp, last_ingested_at timestamp, ingest_count bigint",
    "ingestion_checkpoints": "workspace_id string, source_fingerprint string, session_high_water bigint, chunk_high_water bigint, lineage_signature string, lineage_manifest_json string, successful_run_id string, checkpointed_at timestamp",
    "workspaces": f"workspace_id string, workspace_slug string, team_name string, workspace_url string, enterprise_id string, raw_json string, source_chunk_id bigint, {_SEEN}",
    "channels": f"workspace_id string, channel_id string, name string, is_private boolean, is_archived boolean, topic string, purpose string, raw_json string, source_chunk_id bigint, {_SEEN}",
    "users": f"workspace_id string, user_id string, username string, real_name string, display_name string, is_bot boolean, is_deleted boolean, is_restricted boolean, profile_json string, raw_json string, source_chunk_id bigint, {_SEEN}",
    "channel_members": "workspace_id string, channel_id string, user_id string, source_chunk_id bigint, first_observed_run_id string, last_observed_run_id string",
    "messages": "message_key string, workspace_id string, channel_id string, ts string, ts_us bigint, source_message_id bigint, source_chunk_id bigint, user_id string, subtype string, text string, search_text string, thread_ts string, parent_ts string, latest_reply_ts string, is_thread_parent boolean, is_thread_reply boolean, is_thread_broadcast boolean, is_edited boolean, edited_ts string, is_deleted boolean, deleted_ts string, file_metadata_json string, raw_json string, payload_hash string, latest_run_id string, first_observed_at timestamp, last_changed_at timestamp, last_observed_at timestamp",
    "reactions": "workspace_id string, channel_id string, message_ts string, emoji_name string, user_id string, reported_count bigint, latest_run_id string",
    "files": f"workspace_id string, file_id string, channel_id string, message_ts string, thread_ts string, user_id string, mode string, filename string, mime_type string, size_bytes bigint, source_url string, local_object_path string, raw_json string, source_chunk_id bigint, {_SEEN}",
    "message_events": "event_id string, workspace_id string, channel_id string, message_ts string, message_key string, event_type string, payload_hash string, raw_json string, run_id string, observed_at timestamp",
}


def struct(ddl: str) -> T.StructType:
    """A StructType from the DDL of this module (needs a session)."""
    return T.StructType.fromDDL(ddl)
