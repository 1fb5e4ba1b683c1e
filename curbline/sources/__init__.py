"""Sources and sinks: positional CSV with declared schemas, curated Parquet, report sinks."""

from curbline.sources.csv_io import (
    count_sink,
    read_segments_csv,
    read_tickets_csv,
    read_tickets_parquet,
    write_curated_tickets,
    write_report_csv,
    write_report_parquet,
    write_report_text,
)

__all__ = [
    "count_sink", "read_segments_csv", "read_tickets_csv", "read_tickets_parquet", "write_curated_tickets",
    "write_report_csv", "write_report_parquet", "write_report_text",
]
