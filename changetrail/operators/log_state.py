"""Rebuild the last known state of each entity from the long change log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import date_parts, event_micros, is_table, source_literals
from ..spec import (
    DATE_PARTS,
    ENTITY,
    FROM_LOG,
    KEYS,
    MICROS,
    OP,
    ORDER,
    REFERENCE,
    TIME,
    USER,
    TableSpec,
    check_semantics,
)


def log_sequence(log: DataFrame) -> Column:
    """The log's tie-breaker, null where the log was written without one."""
    return F.col("seq") if "seq" in log.columns else F.lit(None).cast("string")


def latest_values(log: DataFrame, semantics: str = "strict") -> DataFrame:
    """The latest log row of every entity and column.

    The rank-1 filter is planned as a group limit before the shuffle too, so a large group
    shrinks to one row per task before it moves.
    """
    check_semantics(semantics)
    if semantics == REFERENCE:
        newest = [F.col(TIME).desc()]
    else:
        newest = [event_micros(F.col(TIME)).desc(), log_sequence(log).desc()]
    # Rows equal in all of these are interchangeable for the log's state.
    newest += [F.col(name).desc() for name in (USER, OP, "column_value")]
    ranked = W.partitionBy(*ENTITY, "column_name").orderBy(*newest)
    return log.withColumn("rank", F.row_number().over(ranked)).where("rank = 1").drop("rank")


def pivot_log(log: DataFrame, audit_columns: Sequence[str]) -> DataFrame:
    """Long to wide: one row per entity and change, one column per audited column.

    The columns are named, not looked up in the data, so no job runs to find them. Where a
    change holds several values of one column, which the log allows, the greatest is taken.
    """
    fixed = [OP, *ENTITY, TIME, USER, *DATE_PARTS]
    return log.groupBy(*fixed).pivot("column_name", list(audit_columns)).agg(F.max("column_value"))


def baseline(
    log: DataFrame,
    spec: TableSpec,
    semantics: str = "strict",
    feed: DataFrame | None = None,
    with_origin: bool = True,
) -> DataFrame:
    """Last known wide row per entity, in the conformed shape.

    Strict: each column's own last value. Reference: the values that the entity's last
    logged change holds, other columns being null. Both are one partial aggregation and one
    shuffle. With ``feed`` (conformed), only entities that occur in it are returned; Catalyst
    moves that semi join below the aggregation when the feed's keys are small enough to
    broadcast, and otherwise reuses the aggregation's partitioning for it. Without
    ``with_origin``, the operation, time text and user of the last change are left null and,
    in strict semantics, neither read nor shuffled.
    """
    check_semantics(semantics)
    strict = semantics != REFERENCE
    rows = log.where(is_table(spec) & F.col("column_name").isin(list(spec.audit_columns))).select(
        F.struct(*KEYS).alias("key"),
        event_micros(F.col(TIME)).alias("at") if strict else F.col(TIME).alias("at"),
        log_sequence(log).alias(ORDER) if strict else F.col(USER).alias(ORDER),
        OP,
        TIME,
        USER,
        "column_name",
        "column_value",
    )
    place = ["at", ORDER] if strict else ["at", ORDER, OP]

    def newest(name: str) -> Column:
        return F.max(F.when(F.col("column_name") == name, F.struct(*place, "column_value")))

    origin = [OP, TIME, USER] if with_origin else []
    last = F.max(F.struct(*place, *[name for name in origin if name not in place]))
    state = rows.groupBy("key").agg(
        last.alias("last"),
        *[newest(name).alias(f"c{i}") for i, name in enumerate(spec.audit_columns)],
    )
    if feed is not None:
        state = state.join(feed.select(F.struct(*KEYS).alias("key")).distinct(), "key", "left_semi")

    def value(i: int) -> Column:
        cell = F.col(f"c{i}")
        if strict:
            return cell.getField("column_value")
        in_last_change = [cell.getField(p).eqNullSafe(F.col("last").getField(p)) for p in place]
        return F.when(reduce(Column.__and__, in_last_change), cell.getField("column_value"))

    def of_last(name: str) -> Column:
        return F.col("last").getField(name) if name in origin else F.lit(None).cast("string")

    at = F.col("last").getField("at")
    micros = at if strict else event_micros(at)
    return state.select(
        of_last(OP).alias(OP),
        *source_literals(spec),
        *[F.col("key").getField(k).alias(k) for k in KEYS],
        (of_last(TIME) if strict else at).alias(TIME),
        of_last(USER).alias(USER),
        F.lit(True).alias(FROM_LOG),
        *date_parts(micros),
        micros.alias(MICROS),
        (F.col("last").getField(ORDER) if strict else F.lit(None).cast("string")).alias(ORDER),
        *[value(i).alias(name) for i, name in enumerate(spec.audit_columns)],
    )
