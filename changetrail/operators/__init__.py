from .conform import conform
from .hot_keys import HotKeys
from .log_state import baseline, latest_values, pivot_log
from .previous import lag_previous

__all__ = ["HotKeys", "baseline", "conform", "lag_previous", "latest_values", "pivot_log"]
