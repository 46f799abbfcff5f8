"""Sources and sinks: parquet/CSV scans, stage tables, catalog tables, views."""

from tessera.sources.io import (
    read_csv,
    read_stage,
    read_table,
    register_views,
    write_csv,
    write_stage,
    write_table,
)

__all__ = [
    "read_csv", "read_stage", "read_table", "register_views",
    "write_csv", "write_stage", "write_table",
]
