"""Put each version of an entity next to the version before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import column
from ..spec import FROM_LOG, KEYS, MICROS, OP, ORDER, REFERENCE, TIME, USER, TableSpec, check_semantics
from .hot_keys import HotKeys, Slices, estimated_bytes, find_slices, with_enough_partitions

# Order of rows at one position: slice header, then the log's state, then feed rows.
_HEADER, _LOGGED, _FEED = 0, 1, 2
_CONTENT = ("now", OP)


def versions(conformed: DataFrame, spec: TableSpec, semantics: str, emit_deletes: bool = False) -> DataFrame:
    """Narrow a conformed frame to what is shuffled: key, position, user and audited values.

    ``at`` is the change time in microseconds, or its text in reference semantics. Constants
    and date parts are left out and added again after the shuffle.
    """
    check_semantics(semantics)
    at = F.col(TIME if semantics == REFERENCE else MICROS)
    values = {name: column(name) for name in spec.audit_columns}
    if emit_deletes:
        kept = ~F.col(OP).eqNullSafe("D")
        values = {name: F.when(kept, value) for name, value in values.items()}
    logged = F.struct(at.alias("at"), F.col(ORDER).alias(ORDER), F.lit(None).cast("array<string>").alias("ties"))
    order = F.col(ORDER)
    if not spec.sequence and semantics != REFERENCE:
        # whatever is new at the log's last instant follows what the log holds of it
        order = F.when(F.col(FROM_LOG), "").otherwise(order)
    return conformed.select(
        *KEYS,
        OP,
        TIME,
        USER,
        at.alias("at"),
        order.alias(ORDER),
        F.when(F.col(FROM_LOG), _LOGGED).otherwise(_FEED).alias("origin"),
        F.when(F.col(FROM_LOG), logged).alias("logged"),
        F.struct(*[value.alias(name) for name, value in values.items()]).alias("now"),
    )


def position() -> Column:
    return F.struct("at", ORDER)


def from_state(state: DataFrame) -> DataFrame:
    """Rows of ``state_as_baseline`` as versions that the log holds."""
    return state.withColumn("origin", F.lit(_LOGGED)).drop(FROM_LOG)


def _set_apart(feed: DataFrame, known: DataFrame) -> DataFrame:
    """Mark versions that have been seen at the entity's last instant, by their content (see ``state.py``).

    They precede nothing: what follows is compared with the state instead.
    """
    key = F.struct(*KEYS).alias("key")
    last = known.select(key, F.col("logged").alias("last"))
    again = (F.col("at") == F.col("last.at")) & F.array_contains("last.ties", F.col(ORDER))
    marked = feed.withColumn("key", key).join(last, "key", "left")
    return marked.withColumn("apart", F.coalesce(again, F.lit(False))).drop("key", "last")


def compare(
    feed: DataFrame,
    spec: TableSpec,
    semantics: str,
    baseline: DataFrame | None = None,
    hot: HotKeys | None = HotKeys(),
    seen: bool = False,
) -> DataFrame:
    """Add ``before`` and ``op_before``: values and operation of the entity's preceding version.

    ``feed`` and ``baseline`` come from ``versions``. Everything happens in one window over
    one shuffle, of as many partitions as the feed's size calls for. With a baseline in strict semantics, ``logged_until`` is the last position
    the log holds for the entity. The result also holds baseline rows: see ``is_feed``.

    A baseline from the state of a table without ``sequence`` costs one more join, which sets apart the versions that
    were seen before at the same instant (``apart``).
    """
    size = estimated_bytes(feed)
    apart = baseline is not None and not spec.sequence and semantics != REFERENCE and seen
    if apart:
        feed, baseline = _set_apart(feed, baseline), baseline.withColumn("apart", F.lit(False))
    keys = list(KEYS[: max(1, min(len(spec.primary_key), len(KEYS)))])
    key_hash = F.xxhash64(*keys)
    rows = feed if baseline is None else feed.unionByName(baseline)
    slices = find_slices(feed, key_hash, position(), hot) if hot else None
    partition = keys
    if slices:
        heads = _headers(slices, rows.where(~F.col("apart")) if apart else rows, keys, key_hash)
        heads = heads.withColumn("apart", F.lit(False)) if apart else heads
        rows = slices.assign(rows, key_hash, position()).unionByName(heads)
        partition = [*keys, "slice"]
    if apart:
        partition = [*partition, "apart"]
    rows = with_enough_partitions(rows, size, partition)

    # Undated rows (strict only) come last, so that they precede no other version.
    at = F.col("at").asc() if semantics == REFERENCE else F.col("at").asc_nulls_last()
    ordered = W.partitionBy(*partition).orderBy(at, ORDER, "origin", *_CONTENT)
    # Lags take plain columns: an expression would be computed, and shuffled, beside its inputs.
    columns = [F.lag("now").over(ordered).alias("before"), F.lag(OP).over(ordered).alias("op_before")]
    if baseline is not None and semantics != REFERENCE:
        whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        columns.append(F.max("logged").over(whole).alias("logged_until"))
    return rows.select("*", *columns)


def is_apart(compared: DataFrame) -> Column:
    return F.col("apart") if "apart" in compared.columns else F.lit(False)


def is_feed() -> Column:
    return F.col("origin") == _FEED


def _headers(slices: Slices, rows: DataFrame, keys: list[str], key_hash: Column) -> DataFrame:
    """One row per slice of a hot key: the last version of the slice before it.

    The groups are pre-aggregated where the rows are read, so one row per slice and task is
    shuffled; what the window orders is one row per slice.
    """
    hot_rows = slices.assign(rows, key_hash, position(), only_hot=True)
    last = F.max(F.struct("at", ORDER, "origin", *_CONTENT, *[k for k in KEYS if k not in keys]))
    ends = hot_rows.groupBy(*keys, "slice").agg(last.alias("last"), F.max("logged").alias("logged"))
    by_slice = W.partitionBy(*keys).orderBy("slice")
    whole = by_slice.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    chained = ends.select(
        *keys,
        "slice",
        F.lag("last").over(by_slice).alias("last"),
        F.max("logged").over(whole).alias("logged"),
    )
    return chained.select(
        *keys,
        *[F.col("last").getField(k).alias(k) for k in KEYS if k not in keys],
        F.col("last").getField(OP).alias(OP),
        F.lit(None).cast("string").alias(TIME),
        F.lit(None).cast("string").alias(USER),
        F.col("last").getField("at").alias("at"),
        F.col("last").getField(ORDER).alias(ORDER),
        F.lit(_HEADER).alias("origin"),
        "logged",
        F.col("last").getField("now").alias("now"),
        "slice",
    )


def value_pairs(spec: TableSpec) -> list[tuple[Column, Column]]:
    """(new, previous) value of each audited column of a compared frame."""
    now, before = F.col("now"), F.col("before")
    return [(now.getField(name), before.getField(name)) for name in spec.audit_columns]


def lag_previous(
    conformed: DataFrame, spec: TableSpec, semantics: str = "strict", hot: HotKeys | None = HotKeys()
) -> DataFrame:
    """Entity, position, and for each audited column its value and ``prev_<column>``."""
    compared = compare(versions(conformed, spec, semantics), spec, semantics, hot=hot)
    pairs = dict(zip(spec.audit_columns, value_pairs(spec)))
    return compared.where(is_feed()).select(
        OP,
        *KEYS,
        TIME,
        USER,
        *[now.alias(name) for name, (now, _) in pairs.items()],
        *[before.alias(f"prev_{name}") for name, (_, before) in pairs.items()],
    )
