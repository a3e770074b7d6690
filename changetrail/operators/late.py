"""Rows that come after newer ones of their entity: what the log knows of an instant, and repair of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import column, date_parts, event_micros, is_table, source_literals
from ..spec import KEYS, LOG_SCHEMA, OP, ORDER, TIME, USER, TableSpec

_LOGGED, _LATE, _SEEN = 0, 1, 2


def _cells_of(log: DataFrame, spec: TableSpec, entities: DataFrame) -> DataFrame:
    """Log cells of the entities in a frame that has their key columns."""
    rows = log.where(is_table(spec) & F.col("column_name").isin(list(spec.audit_columns))).select(
        *KEYS, F.struct(*KEYS).alias("key"), event_micros(F.col(TIME)).alias("at"), "seq", "column_name", "column_value"
    )
    return rows.join(entities.select(F.struct(*KEYS).alias("key")).distinct(), "key", "left_semi").drop("key")


def known_cells(log: DataFrame, spec: TableSpec, feed: DataFrame) -> DataFrame:
    """Values that a row already logged may have had at a logged instant: each logged one, and the one before it."""
    in_order = W.partitionBy(*KEYS, "column_name").orderBy("at", "seq")
    rows = _cells_of(log, spec, feed).withColumn("before", F.lag("column_value").over(in_order))
    return rows.select(*KEYS, "column_name", "at", F.explode(F.array("column_value", "before")).alias("column_value"))


def repaired_cells(late: DataFrame, log: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Log rows that put late rows in their place.

    ``late`` has the rows (key, ``Op``, time, user, ``at``, ``seq``, ``row_values``), ``state`` what had been seen of
    their entities before them. Each column's late values, logged values and value seen last are put in order of
    time. A late value is logged where it differs from its predecessor; and so, again, is the value seen last
    where a late one now precedes it, so that the log ends in what is true. A logged value that follows a late one needs no
    row: it is a change in either case. A value that the log has at the same position (or, without ``sequence``, instant)
    is not logged again, which makes late rows that are read twice add nothing. What was seen unchanged before a late row came, and
    not last, is not known any more; reading those rows again puts them right too.
    """
    names = F.array(*[F.lit(name) for name in spec.audit_columns])
    origin = (OP, TIME, USER)

    def long(rows: DataFrame, values: str, order: str, kind: int) -> DataFrame:
        return rows.select(
            *KEYS,
            *origin,
            "at",
            F.col(order).alias("seq"),
            F.lit(kind).alias("kind"),
            F.explode(names).alias("column_name"),
            F.col(values).alias("values"),
        ).select("*", F.col("values")[F.col("column_name")].alias("column_value")).drop("values")

    logged = _cells_of(log, spec, late)
    none = F.lit(None).cast("string")
    logged = logged.select("*", F.lit(_LOGGED).alias("kind"), *[none.alias(name) for name in origin])
    key = F.struct(*KEYS).alias("key")
    seen = state.withColumn("key", key).join(late.select(key).distinct(), "key", "left_semi").drop("key")
    every = logged.unionByName(long(late, "row_values", "seq", _LATE)).unionByName(long(seen, "now", ORDER, _SEEN))
    cell = [*KEYS, "column_name"]
    in_order = W.partitionBy(*cell).orderBy("at", "seq", "kind")
    at_once = W.partitionBy(*cell, "at", "column_value", *(["seq"] if spec.sequence else []))
    rows = every.select(
        "*",
        F.lag("column_value").over(in_order).alias("before"),
        F.min("kind").over(at_once).alias("first_kind"),
    )
    fresh = rows.where((F.col("kind") != _LOGGED) & (F.col("first_kind") != _LOGGED)).where(
        ~F.col("column_value").eqNullSafe(F.col("before"))
    )
    sources = source_literals(spec)
    return fresh.select("*", *sources, *date_parts(F.col("at"))).select(*LOG_SCHEMA.names)


def late_values(conformed: DataFrame, spec: TableSpec) -> DataFrame:
    """A conformed frame's dated rows in the shape that ``repaired_cells`` takes."""
    names = F.array(*[F.lit(name) for name in spec.audit_columns])
    values = F.array(*[column(name) for name in spec.audit_columns])
    return conformed.where("change_micros IS NOT NULL").select(
        *KEYS, OP, TIME, USER, F.col("change_micros").alias("at"), F.col(ORDER).alias("seq"),
        F.map_from_arrays(names, values).alias("row_values"),
    )
