"""Targets and Structured Streaming flows: append, SCD 1/2, deletes, snapshots."""

from keelson.streaming.target import ChangeTable, SnapshotTable

__all__ = ["ChangeTable", "SnapshotTable"]
