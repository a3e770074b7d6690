from .control import control_table, historical_tables, specs, to_process, to_purge
from .feed import dated_paths, read_feed, with_file_kind
from .log import listed_tables, log_tables, log_tables_by_db, read_log, scan_table, table_in_log, without_table

__all__ = [
    "control_table",
    "dated_paths",
    "historical_tables",
    "listed_tables",
    "log_tables",
    "log_tables_by_db",
    "read_feed",
    "read_log",
    "scan_table",
    "specs",
    "table_in_log",
    "to_process",
    "to_purge",
    "with_file_kind",
    "without_table",
]
