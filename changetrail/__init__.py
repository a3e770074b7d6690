"""Column-level change audit: change feeds in, one long change log out."""

from .operators import HotKeys, baseline, conform, lag_previous, latest_values, pivot_log
from .plans import (
    append_log,
    change_log,
    changed_rows,
    clean_table,
    compact_table,
    held_rows,
    incremental_change_log,
    initial_change_log,
    load_feed,
    purge_table,
    run,
)
from .session import build_session
from .sources import (
    control_table,
    dated_paths,
    historical_tables,
    listed_tables,
    log_tables,
    log_tables_by_db,
    read_feed,
    read_log,
    scan_table,
    table_in_log,
    without_table,
)
from .spec import TableSpec
from .streaming import stream_change_log

__all__ = [
    "HotKeys",
    "TableSpec",
    "append_log",
    "baseline",
    "build_session",
    "change_log",
    "changed_rows",
    "clean_table",
    "compact_table",
    "conform",
    "control_table",
    "dated_paths",
    "held_rows",
    "historical_tables",
    "incremental_change_log",
    "initial_change_log",
    "lag_previous",
    "latest_values",
    "listed_tables",
    "load_feed",
    "log_tables",
    "log_tables_by_db",
    "pivot_log",
    "purge_table",
    "read_feed",
    "read_log",
    "run",
    "scan_table",
    "stream_change_log",
    "table_in_log",
    "without_table",
]
