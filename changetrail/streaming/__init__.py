from .files import stream_change_log

__all__ = ["stream_change_log"]
