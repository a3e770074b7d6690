"""Bring a raw feed into the one shape that every later step works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    column,
    content_order,
    date_parts,
    event_micros,
    key_columns,
    sequence_text,
    source_literals,
)
from ..spec import FEED_TIME, FEED_USER, FROM_LOG, MICROS, OP, ORDER, TIME, USER, TableSpec


def _text_or_null(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that the frame has, as text, else null."""
    for name in names:
        if name in df.columns:
            return column(name).cast("string")
    return F.lit(None).cast("string")


def conform(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """Project a feed to operation, entity, time, user, date parts and audited columns as text.

    Columns that are neither are never read. An audited column that this feed lacks (added
    later, or retired) is null; a missing key or time column is an error.
    """
    needed = [*spec.primary_key, *spec.sequence]
    missing = [name for name in needed if name not in feed.columns]
    time_name = FEED_TIME if FEED_TIME in feed.columns else TIME
    if time_name not in feed.columns:
        missing.append(FEED_TIME)
    if missing:
        raise ValueError(f"{spec.name}: the feed lacks {missing}")
    if not set(spec.audit_columns).intersection(feed.columns):
        raise ValueError(f"{spec.name}: the feed has none of {list(spec.audit_columns)}")

    op = _text_or_null(feed, OP)
    user = _text_or_null(feed, FEED_USER, USER)
    time = column(time_name)
    micros = event_micros(time, feed.schema[time_name].dataType)
    audited = {name: _text_or_null(feed, name) for name in spec.audit_columns}
    if spec.sequence:
        order = sequence_text(feed, spec.sequence)
    else:
        order = content_order([op, user, *audited.values()])
    return feed.select(
        op.alias(OP),
        *source_literals(spec),
        *key_columns(spec),
        time.cast("string").alias(TIME),
        user.alias(USER),
        F.lit(False).alias(FROM_LOG),
        *date_parts(micros),
        micros.alias(MICROS),
        order.alias(ORDER),
        *[value.alias(name) for name, value in audited.items()],
    )
