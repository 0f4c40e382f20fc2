"""Incremental ingest with Structured Streaming."""

from citylake.streaming.ingest import (
    failed_slots,
    ingest_drifting,
    ingest_drifting_stream,
    ingest_mixed_stream,
    ingest_stream,
    read_drifting,
    rejected_files,
    reload_republished,
)

__all__ = [
    "failed_slots", "ingest_drifting", "ingest_drifting_stream", "ingest_mixed_stream", "ingest_stream", "read_drifting",
    "rejected_files", "reload_republished",
]
