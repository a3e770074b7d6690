from .change_log import change_log, changed_rows, held_rows, incremental_change_log, initial_change_log
from .run import load_feed, run
from .sink import append_log, clean_table, compact_table, purge_table

__all__ = [
    "append_log",
    "change_log",
    "changed_rows",
    "clean_table",
    "compact_table",
    "held_rows",
    "incremental_change_log",
    "initial_change_log",
    "load_feed",
    "purge_table",
    "run",
]
