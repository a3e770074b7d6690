"""Column expressions. All are built-in Spark functions, so they stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import DATE_PARTS, KEYS, REFERENCE, SOURCE, TableSpec

_LOWEST_BIGINT = -(2**63)


def column(name: str) -> Column:
    """Reference a column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def source_literals(spec: TableSpec) -> list[Column]:
    return [F.lit(value).alias(name) for name, value in spec.source.items()]


def is_table(spec: TableSpec) -> Column:
    """Exact, null-safe test that a log row belongs to the table."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in spec.source.items()])


def key_columns(spec: TableSpec) -> list[Column]:
    """Map the configured key columns by position to k1, k2, k3, padding with null."""
    keys = [column(name).cast("string") for name in spec.primary_key]
    if len(keys) > len(KEYS) and spec.extra_keys == "fold":
        keep = len(KEYS) - 1
        keys = [*keys[:keep], F.to_json(F.array(*keys[keep:]))]
    padded = (keys + [F.lit(None).cast("string")] * len(KEYS))[: len(KEYS)]
    return [key.alias(name) for key, name in zip(padded, KEYS)]


def event_micros(time: Column, kind: T.DataType = T.StringType()) -> Column:
    """Change time as microseconds since the epoch; null where it is no timestamp.

    Times that are timestamps already are not taken through text.
    """
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(time.cast("timestamp"))
    return F.unix_micros(F.try_to_timestamp(time.cast("string")))


def date_parts(micros: Column) -> list[Column]:
    """Year, month and day of a change time in microseconds; null where there is none."""
    moment = F.timestamp_micros(micros)
    parts = (F.year(moment), F.month(moment), F.dayofmonth(moment))
    return [part.alias(name) for part, name in zip(parts, DATE_PARTS)]


def sequence_text(df: DataFrame, names: Sequence[str]) -> Column:
    """Render ordering columns as one text whose text order is the columns' order.

    Integers become a sign digit and 19 digits, counted from the lowest bigint when negative; decimals (of 37 digits at
    most) are counted from the lowest of their type, in as many digits as it may have;
    dates, timestamps and text are already ordered as text. Parts are joined by the lowest
    character there is.
    """
    parts = []
    for name in names:
        value = column(name)
        kind = df.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            number = value.cast("bigint")
            negative = F.lpad((number - F.lit(_LOWEST_BIGINT)).cast("string"), 20, "0")
            digits = F.lpad(number.cast("string"), 19, "0")
            value = F.when(number >= 0, F.concat(F.lit("1"), digits)).otherwise(negative)
        elif isinstance(kind, T.DecimalType) and kind.precision < 38:
            lowest = F.lit(10 ** (kind.precision - kind.scale)).cast(f"decimal({kind.precision + 1},{kind.scale})")
            counted = (value + lowest).cast(f"decimal({kind.precision + 1},{kind.scale})")
            value = F.lpad(counted.cast("string"), kind.precision + 2, "0")
        elif isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        else:
            raise ValueError(f"column {name} of type {kind.simpleString()} cannot order changes")
        parts.append(F.coalesce(value, F.lit("")))
    return parts[0] if len(parts) == 1 else F.concat_ws("\x01", *parts)


def content_order(columns: Sequence[Column]) -> Column:
    """A stable order for rows that nothing else orders: a hash of their content."""
    return F.hex(F.xxhash64(*columns))


def plain_content(order: Column) -> Column:
    """The content's hash in an order that ``generation_after`` may have made."""
    return F.when(order.startswith("~"), F.substring(order, 10, 1 << 20)).otherwise(order)


def generation_after(prior: Column, content: Column) -> Column:
    """An order for content that comes after what was known of the same instant, whatever the hashes are.

    ``~``, which no hash holds and which sorts after all of them, the number of the generation in eight digits,
    and the content's hash.
    """
    known = F.when(prior.startswith("~"), F.substring(prior, 2, 8).cast("int")).otherwise(F.lit(0))
    number = F.lpad((F.coalesce(known, F.lit(0)) + 1).cast("string"), 8, "0")
    return F.concat(F.lit("~"), number, content)


def cell_changed(value: Column, previous: Column, semantics: str) -> Column:
    """Does one cell differ from its predecessor?

    Strict: any difference, nulls being equal. Reference: an unequal non-null value, or
    whatever has no (or a null) predecessor; a change to null goes unnoticed.
    """
    if semantics == REFERENCE:
        return (value != previous) | previous.isNull()
    return ~value.eqNullSafe(previous)


def any_cell_changed(pairs: Sequence[tuple[Column, Column]], semantics: str) -> Column:
    """Does a row differ from its predecessor in any audited column?"""
    if semantics == REFERENCE:
        tests = [(v != p) | (p.isNull() & v.isNotNull()) for v, p in pairs]
    else:
        tests = [~v.eqNullSafe(p) for v, p in pairs]
    return reduce(Column.__or__, tests)


def file_kind(file_name: Column) -> Column:
    """Kind of a feed file by its name: full load, change capture, or neither.

    Fixed values: full loads begin with LOAD, change captures with their date in eight digits.
    """
    return (
        F.when(file_name.startswith("LOAD"), "full")
        .when(file_name.rlike("^[0-9]{8}"), "cdc")
        .otherwise("skip")
    )


def in_date_window(moment: Column, run_date: date, days: int) -> Column:
    """The ``days`` days before the run date, or the run date itself for 0.

    Written as plain bounds on the column so that it reaches scans and partition pruning.
    """
    day = F.lit(run_date)
    first, last = (day, F.date_add(day, 1)) if days == 0 else (F.date_sub(day, days), day)
    return (moment >= first) & (moment < last)
