"""One run over the control table: purge, load and report."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import conform
from ..operators.hot_keys import BYTES_PER_TASK, UNKNOWN_BYTES, HotKeys, estimated_bytes, partitions_of
from ..operators.late import repaired_cells
from ..sources.control import control_rows, historical_tables, spec_of
from ..sources.feed import read_feed
from ..sources.batches import FULL, HELD, LOAD, LOGGED, new_id, publish, published
from ..sources.log import load_finished, read_log, table_in_log
from ..spec import DATE_PARTS, KEYS, LOG_SCHEMA, OP, SOURCE, STRICT, TIME, USER, TableSpec
from .change_log import change_log, change_log_and_held_rows, without_known
from .sink import append_log, purge_table, state_root, write_log
from .table_state import buckets_for, outgrown, read_state, state_of_log, touched_buckets, write_state

REPORT_SCHEMA = (
    "rds string, db string, tb string, action string, status string, feed_rows bigint, "
    "changes bigint, behind_rows bigint, undated_rows bigint, finished_at timestamp, "
    "seconds double, error string"
)
_COUNTS = ("feed_rows", "changes", "behind_rows", "undated_rows")

# Settings that a load adjusts, and the rule that would replace a plan whose
# result turns out empty, and with it the counters inside that plan.
_PARTITIONS = "spark.sql.shuffle.partitions"
_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_DROPS_COUNTERS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"

# Compressed columns that one task gets; adaptive execution merges what turns out small.
_BYTES_PER_PARTITION = BYTES_PER_TASK


_IN_USE: dict[str, tuple[int, dict]] = {}
_LOCK = threading.Lock()


@contextmanager
def restored_settings(spark: SparkSession):
    """Put the settings that loads adjust back as they were, once no load of this session is under way any more."""
    session = spark.sparkContext.applicationId + spark._jsparkSession.sessionUUID()
    with _LOCK:
        users, before = _IN_USE.get(session) or (0, {n: spark.conf.get(n, None) for n in (_PARTITIONS, _EXCLUDED)})
        _IN_USE[session] = (users + 1, before)
    try:
        yield
    finally:
        with _LOCK:
            users, before = _IN_USE.pop(session)
            if users > 1:
                _IN_USE[session] = (users - 1, before)
            for name, value in before.items() if users == 1 else ():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def _keep_counters(spark: SparkSession) -> None:
    """Let counters report also when nothing changed."""
    rules = spark.conf.get(_EXCLUDED, None)
    if not rules:
        spark.conf.set(_EXCLUDED, _DROPS_COUNTERS)
    elif _DROPS_COUNTERS not in rules:
        spark.conf.set(_EXCLUDED, f"{rules},{_DROPS_COUNTERS}")


def partitions_for(*frames: DataFrame) -> int:
    """Shuffle partitions that the frames call for by Catalyst's size estimates."""
    sizes = [estimated_bytes(frame) for frame in frames]
    known = sum(size for size in sizes if size < UNKNOWN_BYTES)
    return partitions_of(known, _BYTES_PER_PARTITION)


def _allow_partitions(spark: SparkSession, wanted: int) -> None:
    """Raise the number of shuffle partitions; adaptive execution merges the small ones."""
    if wanted > int(spark.conf.get(_PARTITIONS)):
        spark.conf.set(_PARTITIONS, str(wanted))


# What is done about rows that come after newer ones of their entity.
HOLD, REPAIR = "hold", "repair"
_BATCH_SCHEMA = T.StructType(
    [*LOG_SCHEMA.fields[:8], T.StructField("reason", T.StringType()), T.StructField("at", T.LongType())]
    + [T.StructField("row_values", T.MapType(T.StringType(), T.StringType()))]
)


def load_feed(
    conformed: DataFrame,
    spec: TableSpec,
    log_path: str,
    semantics: str = STRICT,
    *,
    held_path: str | None = None,
    state_path: str | None = None,
    late: str = HOLD,
    emit_deletes: bool = False,
    hot: HotKeys | None = HotKeys(),
) -> dict:
    """Append what a conformed feed changes to the log; return the counts.

    Strict semantics compares the feed with the table's state beside the log (``<log_path>_state``, or
    ``state_path``), which the same load brings up to date; the log itself is read only where it has rows that came
    without state. Log rows and the rows held back are written by one job, from one comparison; the rows held back are then
    copied to ``held_path`` (by default ``<log_path>_held``). All of it becomes visible at once, by one
    marker (see ``batches.py``): a load that ends before leaves the log as it was.

    ``late="repair"`` also logs what rows behind newer ones change (see ``repaired_cells``); for that the log
    of their entities is read. They count as behind, and are kept as such, in either case.

    Counting rides on the write; feed rows that Spark reads again after losing an executor
    count again, which affects the report and nothing else. An empty feed writes nothing.
    """
    if late not in (HOLD, REPAIR):
        raise ValueError(f"late must be '{HOLD}' or '{REPAIR}', not {late!r}")
    with restored_settings(conformed.sparkSession):
        if semantics != STRICT:
            return _load_plain(conformed, spec, log_path, semantics, hot)
        return _load(conformed, spec, log_path, held_path, state_path, late, emit_deletes, hot)


def _prepare(conformed: DataFrame, *others: DataFrame | None) -> None:
    spark = conformed.sparkSession
    _keep_counters(spark)
    _allow_partitions(spark, partitions_for(*[df for df in (conformed, *others) if df is not None]))


def _load_plain(
    conformed: DataFrame, spec: TableSpec, log_path: str, semantics: str, hot: HotKeys | None
) -> dict:
    """A load that compares with the log, and writes nothing but log rows."""
    spark = conformed.sparkSession
    log = read_log(spark, log_path, spec) if table_in_log(spark, log_path, spec) else None
    action = "initial" if log is None else "incremental"
    if conformed.isEmpty():
        return {"action": action, **dict.fromkeys(_COUNTS, 0)}
    _prepare(conformed, log)
    read, written = Observation(), Observation()
    append_log(change_log(conformed, spec, semantics, log=log, hot=hot, counts=read), log_path, spec, written)
    return {"action": action, **read.get, **written.get}


def _load(
    conformed: DataFrame,
    spec: TableSpec,
    log_path: str,
    held_path: str | None,
    state_path: str | None,
    late: str,
    emit_deletes: bool,
    hot: HotKeys | None,
) -> dict:
    spark = conformed.sparkSession
    log_path = log_path.rstrip("/")
    folder = f"{log_path}/{spec.log_folder}"
    states = f"{(state_path or state_root(log_path)).rstrip('/')}/{spec.log_folder}"
    since = published(spark, folder)
    action = "incremental" if since.batches else "initial"
    if conformed.isEmpty():
        return {"action": action, **dict.fromkeys(_COUNTS, 0)}
    if since.state:
        buckets, kind = since.buckets, LOAD
        state = read_state(spark, states, since)
        if outgrown(size := estimated_bytes(state), buckets):
            kind = f"{FULL}{(buckets := buckets_for(size))}"
        else:
            state = read_state(spark, states, since, touched_buckets(conformed, buckets))
    else:
        log = read_log(spark, log_path, spec)
        sizes = [size for size in map(estimated_bytes, (conformed, log)) if size < UNKNOWN_BYTES]
        kind = f"{FULL}{(buckets := buckets_for(sum(sizes)))}"
        state = state_of_log(log, spec)
    _prepare(conformed, state)

    batch, read, written = new_id(), Observation(), Observation()
    before = state if since.batches else None
    rows = change_log_and_held_rows(
        conformed, spec, state=before, emit_deletes=emit_deletes, hot=hot, counts=read
    )
    if since.batches and not since.state and not spec.sequence:
        rows = without_known(rows, conformed, read_log(spark, log_path, spec), spec)
    outcome = F.when(F.col("reason").isNull(), LOGGED).otherwise(HELD)
    # Neither the state nor the copy of held rows waits for the log's rows: their tasks fill the cores those leave idle.
    with ThreadPoolExecutor(max_workers=2) as pool:
        beside = [pool.submit(write_state, state, conformed, spec, states, batch, buckets)]
        write_log(
            rows.withColumn("outcome", outcome).drop(*SOURCE),
            f"{folder}/batch={batch}",
            ["outcome", "column_name", *DATE_PARTS],
            written,
        )
        counts = {**read.get, **written.get}
        if counts["behind_rows"] + counts["undated_rows"]:
            held = spark.read.schema(_BATCH_SCHEMA).parquet(f"{folder}/batch={batch}/outcome={HELD}")
            values = [F.col("row_values").getItem(name).alias(name) for name in spec.audit_columns]
            held_path = held_path or f"{log_path}_held"
            copy = held.select("reason", OP, *KEYS, TIME, USER, *values).write.mode("append")
            beside.append(pool.submit(copy.parquet, f"{held_path.rstrip('/')}/{spec.log_folder}"))
            if late == REPAIR and counts["behind_rows"]:
                behind = held.where("reason = 'behind'")
                repaired = repaired_cells(behind, read_log(spark, log_path, spec), state, spec).drop(*SOURCE)
                added = Observation()
                target = f"{folder}/batch={batch}/outcome={LOGGED}"
                write_log(repaired, target, ["column_name", *DATE_PARTS], added)
                counts["changes"] += added.get["changes"]
        for job in beside:
            job.result()
    publish(spark, folder, since, batch, kind)
    return {"action": action, **counts}


def run(
    spark: SparkSession,
    control: DataFrame,
    feed_root: str,
    log_path: str,
    run_date: date,
    *,
    days: int = 0,
    selector: str = "{}",
    semantics: str = STRICT,
    last_only: bool = False,
    held_path: str | None = None,
    state_path: str | None = None,
    late: str = HOLD,
    emit_deletes: bool = False,
    hot: HotKeys | None = HotKeys(),
    tables_at_once: int = 4,
    merge_schema: bool = True,
) -> DataFrame:
    """Process every control row and report one row per table.

    A row that is invalid or whose table fails is reported as failed with its error; the others
    still run. Tables write to separate folders, so ``tables_at_once`` of them share the cluster;
    rows of the same table are processed one after the other, in their order.
    """

    def process(row: Row) -> tuple:
        historical = row["is_historical"]
        started = time.monotonic()
        detail: dict = {"action": "purge" if row["IsDelete"] else "load", "status": "done"}
        try:
            spec = spec_of(row)
            if spec.is_delete:
                purge_table(spark, log_path, spec, state_path)
            else:
                # a first load that was cut short is read in full again
                loaded = load_finished(spark, log_path, spec)
                mode = "incremental" if loaded else "historical" if historical else "full"
                feed = read_feed(
                    spark, feed_root, spec, mode, run_date=run_date, days=days, merge_schema=merge_schema
                )
                detail |= load_feed(
                    conform(feed, spec),
                    spec,
                    log_path,
                    semantics,
                    held_path=held_path,
                    state_path=state_path,
                    late=late,
                    emit_deletes=emit_deletes,
                    hot=hot,
                )
                if not detail["feed_rows"]:
                    detail["status"] = "empty"
        except Exception as error:  # one table's failure must not hide the others' results
            detail |= {"status": "failed", "error": f"{type(error).__name__}: {error}"}
        return (
            row["rds_name"],
            row["db_name"],
            row["tb_name"],
            detail["action"],
            detail["status"],
            *[detail.get(name) for name in _COUNTS],
            datetime.now(timezone.utc),
            time.monotonic() - started,
            detail.get("error"),
        )

    rows = control_rows(historical_tables(control, selector))
    if last_only:
        rows = rows[-1:]
    tables: dict[tuple, list[int]] = {}
    for place, row in enumerate(rows):
        tables.setdefault((row["rds_name"], row["db_name"], row["tb_name"]), []).append(place)

    def in_order(places: list[int]) -> list[tuple[int, tuple]]:
        return [(place, process(rows[place])) for place in places]

    with restored_settings(spark):
        done = _in_parallel(in_order, list(tables.values()), tables_at_once)
    report = [result for _, result in sorted((x for part in done for x in part), key=lambda x: x[0])]
    return spark.createDataFrame(report, REPORT_SCHEMA)


def _in_parallel(process: Callable, groups: list, workers: int) -> list:
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        return list(pool.map(process, groups))
