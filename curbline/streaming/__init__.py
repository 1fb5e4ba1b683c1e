"""Structured Streaming: incremental segment counts."""

from curbline.streaming.incremental import (
    read_tickets_stream_csv,
    read_tickets_stream_parquet,
    report_from_counts,
    start_segment_counts,
    stream_segment_counts,
)

__all__ = [
    "read_tickets_stream_csv", "read_tickets_stream_parquet", "report_from_counts", "start_segment_counts",
    "stream_segment_counts",
]
