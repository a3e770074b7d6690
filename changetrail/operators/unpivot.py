"""Turn changed rows into one row per changed cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import any_cell_changed, cell_changed, date_parts, event_micros, generation_after, source_literals
from ..spec import KEYS, LOG_COLUMNS, OP, ORDER, REFERENCE, TIME, USER, TableSpec
from .previous import value_pairs


def row_changed(spec: TableSpec, semantics: str, emit_deletes: bool = False) -> Column:
    """Filter for compared rows that differ from the version before in an audited column."""
    changed = any_cell_changed(value_pairs(spec), semantics)
    return changed | _first_delete() if emit_deletes else changed


def _first_delete() -> Column:
    """A delete whose preceding version is not one already."""
    return F.col(OP).eqNullSafe("D") & ~F.col("op_before").eqNullSafe("D")


def log_order(compared: DataFrame, spec: TableSpec) -> Column:
    """The tie-breaker that the log keeps: where a hash serves for one, versions that are new at the instant that
    was logged last come after those that it holds."""
    if spec.sequence or "logged_until" not in compared.columns:
        return F.col(ORDER)
    until = F.col("logged_until")
    same = F.col("at").eqNullSafe(until.getField("at")) & until.isNotNull()
    return F.when(same, generation_after(until.getField(ORDER), F.col(ORDER))).otherwise(F.col(ORDER))


def unpivot_changes(
    compared: DataFrame,
    spec: TableSpec,
    semantics: str,
    keep_previous: bool = False,
    emit_deletes: bool = False,
    held: Column | None = None,
) -> DataFrame:
    """Wide to long with (name, value, previous) triples, keeping changed cells only.

    ``held`` gives the reason why a row is held back, null for others. Such a row is kept as it is, as one
    row with its ``reason`` and all values (``row_values``), beside the cells of the others, which have neither.
    """
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            now.alias("column_value"),
            before.alias("previous_value"),
        )
        for name, (now, before) in zip(spec.audit_columns, value_pairs(spec))
    ]
    listed = F.array(*cells)
    wanted = row_changed(spec, semantics, emit_deletes)
    extra = [_first_delete().alias("deleted")] if emit_deletes else []
    if held is not None:
        text = F.lit(None).cast("string")
        whole = F.struct(text.alias("column_name"), text.alias("column_value"), text.alias("previous_value"))
        values = F.map_from_arrays(
            F.array(*[F.lit(name) for name in spec.audit_columns]),
            F.array(*[now for now, _ in value_pairs(spec)]),
        )
        listed = F.when(held.isNotNull(), F.array(whole)).otherwise(listed)
        wanted = held.isNotNull() | wanted
        extra += [held.alias("reason"), F.when(held.isNotNull(), values).alias("row_values")]
        extra += [F.when(held.isNotNull(), F.col("at")).alias("at")]
    changed = cell_changed(F.col("column_value"), F.col("previous_value"), semantics)
    if emit_deletes:
        changed = changed | F.col("deleted")
    if held is not None:
        changed = F.when(F.col("reason").isNull(), changed).otherwise(F.lit(True))
    micros = event_micros(F.col(TIME)) if semantics == REFERENCE else F.col("at")
    rows = compared.where(wanted).select(
        OP,
        *source_literals(spec),
        *KEYS,
        TIME,
        USER,
        *date_parts(micros),
        log_order(compared, spec).alias("seq"),
        *extra,
        F.inline(listed),
    )
    kept = list(LOG_COLUMNS)
    if semantics != REFERENCE:
        kept.append("seq")
    if keep_previous:
        kept.append("previous_value")
    if held is not None:
        kept += ["reason", "row_values", "at"]
    return rows.where(changed).select(*kept)
