"""Sources and sinks: typed CSV loader/exporter, Parquet, and the mapping
of the TPC-H-like test tables onto the model (:mod:`.fixtures`)."""

from tidemark.sources.files import (
    export_csv,
    latest_month,
    load_tables,
    read_csv,
    read_parquet,
    refresh_months,
    write_parquet,
    write_table,
)
from tidemark.sources.raw import load_accepted, load_raw, read_raw, rejects

__all__ = [
    "export_csv",
    "latest_month",
    "load_accepted",
    "load_raw",
    "load_tables",
    "read_csv",
    "read_parquet",
    "read_raw",
    "refresh_months",
    "rejects",
    "write_parquet",
    "write_table",
]
