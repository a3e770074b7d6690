from .expressions import (
    any_cell_changed,
    cell_changed,
    column,
    content_order,
    date_parts,
    event_micros,
    file_kind,
    generation_after,
    in_date_window,
    is_table,
    key_columns,
    plain_content,
    sequence_text,
    source_literals,
)

__all__ = [
    "any_cell_changed",
    "cell_changed",
    "column",
    "content_order",
    "date_parts",
    "event_micros",
    "file_kind",
    "generation_after",
    "in_date_window",
    "is_table",
    "key_columns",
    "plain_content",
    "sequence_text",
    "source_literals",
]
