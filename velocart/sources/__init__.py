"""Sources and sinks: typed loads, scans, namespaces, stored tables."""

from velocart.sources.tables import (
    check_files,
    conform,
    create_namespace,
    file_columns,
    load_typed,
    missing_columns,
    read_table,
    save_table,
    scan_all,
    scan_summary,
    table_path,
)

__all__ = [
    "check_files",
    "conform",
    "create_namespace",
    "file_columns",
    "load_typed",
    "missing_columns",
    "read_table",
    "save_table",
    "scan_all",
    "scan_summary",
    "table_path",
]
