"""The change log of a feed: without a log (initial) and on top of one (incremental)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import event_micros
from ..operators.hot_keys import HotKeys
from ..operators.late import known_cells
from ..operators.log_state import baseline
from ..operators.previous import compare, from_state, is_apart, is_feed, value_pairs, versions
from ..operators.state import state_as_baseline
from ..operators.unpivot import row_changed, unpivot_changes
from ..spec import KEYS, OP, ORDER, REFERENCE, STRICT, TIME, USER, TableSpec, check_semantics


def change_log(
    conformed: DataFrame,
    spec: TableSpec,
    semantics: str = STRICT,
    *,
    log: DataFrame | None = None,
    state: DataFrame | None = None,
    keep_previous: bool = False,
    emit_deletes: bool = False,
    hot: HotKeys | None = HotKeys(),
    counts: Observation | None = None,
) -> DataFrame:
    """One row per entity, audited column and change.

    With ``log``, the entity's state in the log is the version before the feed's first one,
    and only the feed's own changes are returned. Strict semantics then leaves out feed rows
    older than what the log holds for the entity (see ``held_rows``), which makes running a
    feed twice add nothing. ``state`` (see ``state.py``) takes the log's place in that: older then means
    older than what has been seen of the entity, and nothing of the log is read. ``counts``
    observes the feed's rows while the result is written.

    Without ``sequence``, rows at the instant that was logged last are new if their content has not been seen
    at that instant (with ``state``), or else if a cell's value is neither logged there nor the one before it.
    """
    compared = _compared(conformed, spec, semantics, log, emit_deletes, hot, state)
    if counts is not None:
        compared = _counted(compared, spec, semantics, counts)
    out = _behind(compared, spec) | _undated(semantics) | is_apart(compared)
    cells = unpivot_changes(compared.where(is_feed() & ~out), spec, semantics, keep_previous, emit_deletes)
    if log is not None and not spec.sequence and semantics == STRICT:
        cells = without_known(cells, conformed, log, spec)
    return cells


def change_log_and_held_rows(
    conformed: DataFrame,
    spec: TableSpec,
    *,
    state: DataFrame | None = None,
    emit_deletes: bool = False,
    hot: HotKeys | None = HotKeys(),
    counts: Observation | None = None,
) -> DataFrame:
    """The cells of ``change_log`` and, from the same comparison, the rows held back: those have a ``reason``, the
    row's values (``row_values``) and time (``at``), and no column name."""
    compared = _compared(conformed, spec, STRICT, None, emit_deletes, hot, state)
    if counts is not None:
        compared = _counted(compared, spec, STRICT, counts)
    rows = compared.where(is_feed() & ~is_apart(compared))
    return unpivot_changes(rows, spec, STRICT, emit_deletes=emit_deletes, held=_reason(compared, spec))


def _counted(compared: DataFrame, spec: TableSpec, semantics: str, counts: Observation) -> DataFrame:
    return compared.observe(
        counts,
        F.count_if(is_feed()).alias("feed_rows"),
        F.count_if(is_feed() & _behind(compared, spec)).alias("behind_rows"),
        F.count_if(is_feed() & _undated(semantics)).alias("undated_rows"),
    )


def without_known(cells: DataFrame, conformed: DataFrame, log: DataFrame, spec: TableSpec) -> DataFrame:
    """Leave out cells at the log's last instant whose value the log knows there. Others never match."""
    place = F.struct(
        *KEYS,
        "column_name",
        event_micros(F.col(TIME)).alias("at"),
        "column_value",
        F.coalesce(F.col("seq").startswith("~"), F.lit(False)).alias("tied"),
    )
    known = known_cells(log, spec, conformed).select(
        F.struct(*KEYS, "column_name", "at", "column_value", F.lit(True).alias("tied")).alias("place")
    )
    return cells.withColumn("place", place).join(known, "place", "left_anti").drop("place")


def initial_change_log(conformed: DataFrame, spec: TableSpec, semantics: str = STRICT, **options) -> DataFrame:
    """The change log of a table that the log does not hold yet."""
    return change_log(conformed, spec, semantics, **options)


def incremental_change_log(
    conformed: DataFrame, log: DataFrame, spec: TableSpec, semantics: str = STRICT, **options
) -> DataFrame:
    """What a feed adds to the log."""
    return change_log(conformed, spec, semantics, log=log, **options)


def changed_rows(
    conformed: DataFrame, spec: TableSpec, semantics: str = STRICT, hot: HotKeys | None = HotKeys()
) -> DataFrame:
    """Feed rows that differ from the version before in at least one audited column, wide."""
    compared = _compared(conformed, spec, semantics, None, False, hot)
    rows = compared.where(is_feed() & ~_undated(semantics) & row_changed(spec, semantics))
    names = zip(spec.audit_columns, value_pairs(spec))
    return rows.select(OP, *KEYS, TIME, USER, *[now.alias(name) for name, (now, _) in names])


def held_rows(
    conformed: DataFrame,
    spec: TableSpec,
    log: DataFrame | None = None,
    hot: HotKeys | None = HotKeys(),
    state: DataFrame | None = None,
) -> DataFrame:
    """Feed rows that strict semantics leaves out, with the reason.

    ``behind``: older than the log's last change of the entity, that is, either late or read
    again. ``undated``: the change time is no timestamp. With ``state`` instead of the log: older than what
    has been seen of the entity.
    """
    compared = _compared(conformed, spec, STRICT, log, False, hot, state)
    reason = _reason(compared, spec)
    names = zip(spec.audit_columns, value_pairs(spec))
    return (
        compared.where(is_feed())
        .withColumn("reason", reason)
        .where("reason is not null")
        .select("reason", OP, *KEYS, TIME, USER, *[now.alias(name) for name, (now, _) in names])
    )


def _compared(
    conformed: DataFrame,
    spec: TableSpec,
    semantics: str,
    log: DataFrame | None,
    emit_deletes: bool,
    hot: HotKeys | None,
    state: DataFrame | None = None,
) -> DataFrame:
    check_semantics(semantics)
    if log is not None and state is not None:
        raise ValueError("compare with a log or with a state, not with both")
    if emit_deletes and semantics == REFERENCE:
        raise ValueError("reference semantics does not look at deletes")
    feed = versions(conformed, spec, semantics, emit_deletes)
    before = None
    if log is not None:
        # whether the last change was a delete matters only where deletes are logged
        before = baseline(log, spec, semantics, feed=conformed, with_origin=emit_deletes)
        before = versions(before, spec, semantics, emit_deletes)
    elif state is not None:
        if semantics == REFERENCE:
            raise ValueError("reference semantics knows no state beside the log")
        before = from_state(state_as_baseline(state, spec, conformed, emit_deletes))
    return compare(feed, spec, semantics, before, hot, seen=state is not None)


def _reason(compared: DataFrame, spec: TableSpec) -> Column:
    return F.when(_undated(STRICT), "undated").when(_behind(compared, spec), "behind")


def _behind(compared: DataFrame, spec: TableSpec) -> Column:
    """Older than what is known of the entity; a hash says nothing of which of one instant is older."""
    if "logged_until" not in compared.columns:
        return F.lit(False)
    until = F.col("logged_until")
    older = F.col("at") < until.getField("at")
    if spec.sequence:
        order = F.col(ORDER) < F.coalesce(until.getField(ORDER), F.lit(""))
        older = older | ((F.col("at") == until.getField("at")) & order)
    return F.col("at").isNotNull() & F.coalesce(older, F.lit(False))


def _undated(semantics: str) -> Column:
    return F.lit(False) if semantics == REFERENCE else F.col("at").isNull()


__all__ = [
    "change_log",
    "change_log_and_held_rows",
    "changed_rows",
    "held_rows",
    "incremental_change_log",
    "initial_change_log",
]
