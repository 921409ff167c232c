"""DataFrame → DataFrame operators: cursors, pages, change application, snapshots, joins."""

from keelson.operators.changes import (append_only, duplicate_keys, expire_tombstones, live_history, merge_into, quarantine,
                                       latest_per_key, live, make_tombstones, scd1_upsert,
                                       scd1_with_deletes, scd2_history, scd2_with_deletes,
                                       tombstones_since, touch_upsert, union_changes)
from keelson.operators.cursor import (after_cursor, batch_cap, cursor_range, cutoff_at_start,
                                      end_offset, limit_rows, lookback, match_filters, next_page,
                                      order_by_cursor, page_slice)
from keelson.operators.directory import PageDirectory
from keelson.operators.expand import expand_nested, expand_one
from keelson.operators.ordering import next_in_key
from keelson.operators.profile import table_profile
from keelson.operators.schema import infer_schema, nested_as_text, schema_drift, schema_or_fallback
from keelson.operators.schema_log import SchemaLog
from keelson.operators.snapshot import snapshot_changes, snapshot_diff, snapshot_scd1, snapshot_scd2

__all__ = [
    "PageDirectory", "SchemaLog",
    "after_cursor", "append_only", "batch_cap", "cursor_range", "cutoff_at_start",
    "duplicate_keys", "end_offset", "expand_nested", "expand_one", "expire_tombstones",
    "infer_schema", "latest_per_key", "limit_rows", "live", "live_history", "lookback", "make_tombstones", "merge_into", "quarantine",
    "match_filters", "nested_as_text", "next_in_key", "next_page", "order_by_cursor",
    "page_slice", "scd1_upsert", "scd1_with_deletes", "scd2_history", "scd2_with_deletes",
    "schema_drift", "schema_or_fallback", "snapshot_changes", "snapshot_diff", "snapshot_scd1",
    "snapshot_scd2", "table_profile", "tombstones_since", "touch_upsert", "union_changes",
]
