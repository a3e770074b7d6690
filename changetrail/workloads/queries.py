"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import in_date_window
from ..operators import HotKeys, baseline, conform, lag_previous, latest_values, pivot_log
from ..plans import (
    append_log,
    change_log,
    changed_rows,
    compact_table,
    held_rows,
    incremental_change_log,
    initial_change_log,
    load_feed,
    purge_table,
    run,
)
from ..plans.table_state import read_state
from ..sources import (
    control_table,
    historical_tables,
    listed_tables,
    log_tables_by_db,
    read_feed,
    read_log,
    scan_table,
    storage,
    to_process,
    to_purge,
    with_file_kind,
)
from ..sources.batches import published
from ..spec import REFERENCE, STRICT
from ..streaming import stream_change_log
from .feeds import (
    EVENT_TYPES,
    EVENTS,
    EVENTS_BAD,
    EVENTS_QUIET,
    EVENTS_TWICE,
    EVENTS_X,
    FIRST_TYPES,
    LINEITEM,
    LINEITEM_FOUR_KEYS,
    ORDERS,
    ORDERS_CUT,
    events_feed,
    events_log,
    events_of_one_instant,
    events_partly_undated,
    events_with_deletes,
    events_with_gaps,
    history,
    lineitem_feed,
    news,
    orders_feed,
    stage,
    stage_full_and_daily,
    table,
    written_log,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Run date of the staged feeds, and the cut used to exercise hot keys.
RUN_DATE = date(2024, 1, 31)
TINY_SLICES = HotKeys(rows_per_slice=50, check_above_bytes=0)

FEED_COLUMNS = ("Op", "event_id", "user_id", "event_type", "value", "props")


def query(name: str) -> Callable:
    """Register a function under the name of the operator it exercises."""

    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = function
        return function

    return register


def _feed_rows(feed: DataFrame) -> DataFrame:
    return feed.select(*FEED_COLUMNS, F.col("update_ts_dms").cast("string").alias("updated_at"))


# Sources


@query("feed_full_load")
def feed_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = storage.scratch_folder(spark, "feed")
    stage_full_and_daily(spark, sf_dir, root, (EVENTS,))
    return _feed_rows(read_feed(spark, root, EVENTS, "full"))


@query("feed_incremental")
def feed_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = storage.scratch_folder(spark, "feed")
    stage_full_and_daily(spark, sf_dir, root, (EVENTS,))
    return _feed_rows(read_feed(spark, root, EVENTS, "incremental", run_date=RUN_DATE))


@query("feed_historical")
def feed_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = storage.scratch_folder(spark, "feed")
    feed = events_feed(spark, sf_dir)
    folder = f"{root}/{EVENTS.feed_folder}"
    stage(history(feed).withColumn("Op", F.lit("R")), f"{folder}/FullLoad_Files", "LOAD")
    stage(news(feed), f"{folder}/OldCdc_Files", "20240131")
    return _feed_rows(read_feed(spark, root, EVENTS, "historical"))


@query("feed_file_kind")
def feed_file_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.scratch_folder(spark, "feed")
    feed = events_feed(spark, sf_dir)
    stage(history(feed, "2024-01-10"), folder, "LOAD")
    stage(news(history(feed, "2024-01-20"), "2024-01-10"), folder, "20240110")
    stage(news(feed, "2024-01-20"), folder, "other")
    return with_file_kind(spark.read.parquet(folder)).select("event_id", "file_kind")


@query("feed_date_window")
def feed_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = events_feed(spark, sf_dir)
    return _feed_rows(feed.where(in_date_window(F.col("update_ts_dms"), date(2024, 1, 21), 10)))


@query("feed_date_window_today")
def feed_date_window_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = events_feed(spark, sf_dir)
    return _feed_rows(feed.where(in_date_window(F.col("update_ts_dms"), date(2024, 1, 21), 0)))


def _control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control entry per customer, written and read back as JSON lines."""
    path = storage.scratch_folder(spark, "control")
    named = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("server-"), F.col("c_nationkey").cast("string")).alias("rds_name"),
        F.when(F.col("c_nationkey") < 12, "mysql").otherwise("postgres").alias("rds_instance_type"),
        F.lower("c_mktsegment").alias("db_name"),
        F.col("c_name").alias("tb_name"),
        F.when(F.col("c_acctbal") >= 0, F.array(F.lit("id"), F.lit("line"))).alias("primaryKey"),
        F.array(F.lit("amount"), F.lit("state")).alias("audit_column"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_nationkey") < 5).alias("IsDelete"),
    )
    named.write.json(path)
    return control_table(spark, path, multi_line=False)


def _listed(control: DataFrame) -> DataFrame:
    return control.withColumns(
        {
            "primaryKey": F.array_join("primaryKey", ","),
            "audit_column": F.array_join("audit_column", ","),
        }
    ).drop("sequence", "extra_keys")


@query("control_table")
def control_table_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(_control(spark, sf_dir))


@query("control_purge_and_process")
def control_purge_and_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = _control(spark, sf_dir)
    purge = to_purge(control).withColumn("action", F.lit("purge"))
    process = to_process(control).withColumn("action", F.lit("process"))
    return purge.unionByName(process).select("rds_name", "db_name", "tb_name", "action")


@query("control_historical")
def control_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    selector = '{"furniture": ["Customer#000000000", "Customer#000000005"], "machinery": ["Customer#000000001"]}'
    flagged = historical_tables(_control(spark, sf_dir), selector)
    return flagged.select("rds_name", "db_name", "tb_name", "is_historical")


# Conforming


@query("conform_feed")
def conform_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(events_feed(spark, sf_dir), EVENTS).drop("change_micros")


@query("conform_missing_user")
def conform_missing_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(lineitem_feed(spark, sf_dir), LINEITEM).select(
        "Op", "k1", "k2", "updated_at", "updated_by", "l_quantity", "l_discount", "l_returnflag"
    )


@query("keys_single")
def keys_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(orders_feed(spark, sf_dir), ORDERS).select("k1", "k2", "k3", "updated_at", "change_order")


@query("keys_composite")
def keys_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(lineitem_feed(spark, sf_dir), LINEITEM).select("k1", "k2", "k3", "updated_at")


@query("keys_folded")
def keys_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(lineitem_feed(spark, sf_dir), LINEITEM_FOUR_KEYS).select("k1", "k2", "k3")


@query("date_parts")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(events_partly_undated(spark, sf_dir), EVENTS).select(
        "k1", "updated_at", "updated_by", "yearpart", "monthpart", "daypart"
    )


# Comparing versions


@query("lag_previous")
def lag_of_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_previous(conform(events_with_gaps(spark, sf_dir), EVENTS), EVENTS)


@query("changed_rows")
def changed_rows_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_rows(conform(events_with_gaps(spark, sf_dir), EVENTS), EVENTS)


@query("changed_rows_reference")
def changed_rows_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_rows(conform(events_with_gaps(spark, sf_dir), EVENTS), EVENTS, REFERENCE)


@query("change_log")
def change_log_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(conform(events_with_gaps(spark, sf_dir), EVENTS), EVENTS)


@query("change_log_reference")
def change_log_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(conform(events_with_gaps(spark, sf_dir), EVENTS), EVENTS, REFERENCE)


@query("change_log_with_previous")
def change_log_with_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(conform(orders_feed(spark, sf_dir), ORDERS), ORDERS, keep_previous=True)


@query("change_log_composite_key")
def change_log_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(conform(lineitem_feed(spark, sf_dir), LINEITEM), LINEITEM)


@query("change_log_with_deletes")
def change_log_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(conform(events_with_deletes(spark, sf_dir), EVENTS), EVENTS, emit_deletes=True)


@query("change_log_hot_keys")
def change_log_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys hold all rows; each is cut into slices."""
    return change_log(conform(events_feed(spark, sf_dir), EVENT_TYPES), EVENT_TYPES, hot=TINY_SLICES)


@query("change_log_hot_keys_reference")
def change_log_hot_keys_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = conform(events_feed(spark, sf_dir), EVENT_TYPES)
    return change_log(feed, EVENT_TYPES, REFERENCE, hot=TINY_SLICES)


# State of the log


def _three_logs(spark: SparkSession, sf_dir: str, semantics: str = STRICT) -> DataFrame:
    logs = [
        change_log(conform(events_feed(spark, sf_dir), spec), spec, semantics)
        for spec in (EVENTS, EVENTS_X, EVENT_TYPES)
    ]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


@query("latest_values")
def latest_log_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_values(_three_logs(spark, sf_dir))


@query("latest_values_reference")
def latest_log_values_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_values(_three_logs(spark, sf_dir, REFERENCE), REFERENCE)


@query("pivot_log")
def pivoted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(conform(orders_feed(spark, sf_dir), ORDERS), ORDERS, REFERENCE)
    return pivot_log(log, ORDERS.audit_columns)


def _state(frame: DataFrame) -> DataFrame:
    return frame.drop("change_micros", "change_order", "from_log")


@query("baseline_strict")
def baseline_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS)
    return _state(baseline(log, EVENTS))


@query("baseline_reference")
def baseline_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS, REFERENCE)
    return _state(baseline(log, EVENTS, REFERENCE))


@query("baseline_of_feed_keys")
def baseline_of_feed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the customers that have new orders."""
    feed = orders_feed(spark, sf_dir)
    log = change_log(conform(history(feed, ORDERS_CUT), ORDERS), ORDERS)
    return _state(baseline(log, ORDERS, feed=conform(news(feed, ORDERS_CUT), ORDERS)))


# Initial and incremental logs


@query("initial_change_log")
def initial_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS)


@query("incremental_change_log")
def incremental_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = news(events_feed(spark, sf_dir))
    return incremental_change_log(conform(feed, EVENTS), events_log(spark, sf_dir), EVENTS)


@query("incremental_change_log_reference")
def incremental_log_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = news(events_feed(spark, sf_dir))
    log = events_log(spark, sf_dir, REFERENCE)
    return incremental_change_log(conform(feed, EVENTS), log, EVENTS, REFERENCE)


@query("incremental_change_log_ties")
def incremental_log_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one customer and day are ordered by their sequence."""
    feed = orders_feed(spark, sf_dir)
    log = change_log(conform(history(feed, ORDERS_CUT), ORDERS), ORDERS)
    return incremental_change_log(conform(news(feed, ORDERS_CUT), ORDERS), log, ORDERS)


@query("incremental_change_log_hot_keys")
def incremental_log_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = events_feed(spark, sf_dir)
    log = change_log(conform(history(feed), EVENT_TYPES), EVENT_TYPES, hot=TINY_SLICES)
    return incremental_change_log(conform(news(feed), EVENT_TYPES), log, EVENT_TYPES, hot=TINY_SLICES)


@query("incremental_change_log_replayed")
def incremental_log_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed again, on top of a log that holds its history: only the news are added."""
    feed = conform(events_feed(spark, sf_dir), EVENTS)
    return incremental_change_log(feed, events_log(spark, sf_dir), EVENTS)


@query("incremental_change_log_replayed_reference")
def incremental_log_replayed_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference semantics logs what it reads again a second time."""
    feed = conform(events_feed(spark, sf_dir), EVENTS)
    return incremental_change_log(feed, events_log(spark, sf_dir, REFERENCE), EVENTS, REFERENCE)


@query("incremental_change_log_no_sequence")
def incremental_log_no_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of one instant that arrive one after the other, and then once more, without a column to order them."""
    parts = [conform(f, FIRST_TYPES) for f in events_of_one_instant(spark, sf_dir)]
    path = storage.scratch_folder(spark, "log")
    for part in (*parts, *parts):
        log = read_log(spark, path, FIRST_TYPES)
        append_log(incremental_change_log(part, log, FIRST_TYPES), path, FIRST_TYPES)
    return read_log(spark, path).drop("seq")


@query("load_no_sequence")
def load_no_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by loads, which keep what they have seen at the instant in the table's state."""
    parts = [conform(f, FIRST_TYPES) for f in events_of_one_instant(spark, sf_dir)]
    path = storage.scratch_folder(spark, "log")
    for part in (*parts, *parts):
        load_feed(part, FIRST_TYPES, path)
    return read_log(spark, path).drop("seq")


@query("held_rows")
def held_back_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undated rows, and rows older than what the log holds of their entity."""
    feed = conform(events_partly_undated(spark, sf_dir), EVENTS)
    return held_rows(feed, EVENTS, events_log(spark, sf_dir))


# The written log


@query("log_append_roundtrip")
def log_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of all partition columns, read back."""
    path = storage.scratch_folder(spark, "log")
    feed = events_feed(spark, sf_dir)
    append_log(change_log(conform(history(feed), EVENTS), EVENTS), path)
    fresh = incremental_change_log(conform(news(feed), EVENTS), read_log(spark, path, EVENTS), EVENTS)
    append_log(fresh, path)
    return read_log(spark, path)


@query("log_scan_table")
def log_scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_log(spark, sf_dir, (EVENTS, EVENTS_X))
    return scan_table(read_log(spark, path), EVENTS)


@query("log_tables")
def log_tables_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed_tables(spark, written_log(spark, sf_dir, (EVENTS, EVENTS_X, EVENT_TYPES)))


@query("log_tables_by_db")
def log_tables_listed_by_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = listed_tables(spark, written_log(spark, sf_dir, (EVENTS, EVENTS_X, EVENT_TYPES)))
    return log_tables_by_db(tables).withColumn("tables", F.array_join("tables", ","))


@query("log_compacted")
def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads whose files are rewritten as one batch."""
    path = storage.scratch_folder(spark, "log")
    feed = events_feed(spark, sf_dir)
    for part in (history(feed), news(feed)):
        load_feed(conform(part, EVENTS), EVENTS, path)
    compact_table(spark, path, EVENTS)
    return read_log(spark, path)


# The state beside the log


@query("table_state")
def table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity's version seen last, after two loads."""
    path = storage.scratch_folder(spark, "log")
    feed = events_with_gaps(spark, sf_dir)
    for part in (history(feed), news(feed)):
        load_feed(conform(part, EVENTS), EVENTS, path)
    known = published(spark, f"{path}/{EVENTS.log_folder}")
    state = read_state(spark, f"{path}_state/{EVENTS.log_folder}", known)
    values = [F.col("now").getItem(name).alias(name) for name in EVENTS.audit_columns]
    return state.select("Op", "k1", "k2", "k3", "updated_at", "updated_by", "change_order", *values)


@query("load_from_state")
def load_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History, news, and all of it once more: compared with the state, the last load adds nothing."""
    path = storage.scratch_folder(spark, "log")
    feed = events_feed(spark, sf_dir)
    for part in (history(feed), news(feed), feed):
        load_feed(conform(part, EVENTS), EVENTS, path)
    return read_log(spark, path)


@query("late_rows_repaired")
def late_rows_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events comes after the others, most of it late; later values are put right in the log."""
    path = storage.scratch_folder(spark, "log")
    feed = events_with_gaps(spark, sf_dir)
    load_feed(conform(feed.where("event_id % 3 != 0"), EVENTS), EVENTS, path)
    for _ in range(2):  # read again, late rows add nothing
        load_feed(conform(feed.where("event_id % 3 = 0"), EVENTS), EVENTS, path, late="repair")
    return read_log(spark, path)


@query("purge_table")
def purged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purging one table leaves the one whose name begins alike."""
    path = written_log(spark, sf_dir, (EVENTS, EVENTS_X))
    purge_table(spark, path, EVENTS)
    return read_log(spark, path)


# Whole runs


@query("run_report")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial run, incremental run, then a run that purges one table.

    Among the entries are one that is invalid, one whose table has no file of the day, and one that is there twice.
    """
    root, log = storage.scratch_folder(spark, "feed"), storage.scratch_folder(spark, "log")
    audited = (EVENTS, EVENTS_X, EVENT_TYPES, EVENTS_TWICE)
    stage_full_and_daily(spark, sf_dir, root, audited)
    stage(history(events_feed(spark, sf_dir)).drop("Op"), f"{root}/{EVENTS_QUIET.feed_folder}", "LOAD")
    control = _control_of(spark, (*audited, EVENTS_TWICE, EVENTS_QUIET, EVENTS_BAD))
    last = control.withColumn("IsDelete", F.col("tb_name") == EVENTS.tb)
    reports = [
        run(spark, entries, root, log, RUN_DATE).withColumn("run", F.lit(number))
        for number, entries in enumerate((control, control, last), start=1)
    ]
    return (
        reports[0]
        .unionByName(reports[1])
        .unionByName(reports[2])
        .select("run", "rds", "db", "tb", "action", "status", "feed_rows", "changes", "behind_rows")
    )


@query("run_historical")
def run_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of full-load and old change files together."""
    root, log = storage.scratch_folder(spark, "feed"), storage.scratch_folder(spark, "log")
    feed = events_feed(spark, sf_dir)
    folder = f"{root}/{EVENTS.feed_folder}"
    stage(history(feed).drop("Op"), f"{folder}/FullLoad_Files", "LOAD")
    stage(news(feed), f"{folder}/OldCdc_Files", "20240131")
    run(spark, _control_of(spark, (EVENTS,)), root, log, RUN_DATE, selector='{"app": ["events"]}')
    return read_log(spark, log)


def _control_of(spark: SparkSession, audited: tuple) -> DataFrame:
    """Control entries of specs; ``EVENTS_BAD`` stands for an entry with more key columns than there may be."""
    path = storage.scratch_folder(spark, "control")
    entries = [
        (s.rds, "mysql", s.db, s.tb, list(s.primary_key), list(s.audit_columns), list(s.sequence))
        for s in audited
    ]
    schema = (
        "rds_name string, rds_instance_type string, db_name string, tb_name string, "
        "primaryKey array<string>, audit_column array<string>, sequence array<string>"
    )
    spark.createDataFrame(entries, schema).write.json(path)
    return control_table(spark, path, multi_line=False)


@query("stream_change_log")
def stream_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and news arrive as files; the stream is run after each arrival."""
    root, log = storage.scratch_folder(spark, "feed"), storage.scratch_folder(spark, "log")
    checkpoint = storage.scratch_folder(spark, "checkpoint")
    feed = events_feed(spark, sf_dir)
    folder = f"{root}/{EVENTS.feed_folder}"
    arrivals = ((history(feed), "2024/01/15"), (news(feed), "2024/01/31"))
    for rows, day in arrivals:
        stage(rows, f"{folder}/{day}", day.replace("/", ""))
        stream = stream_change_log(spark, f"{folder}/*/*/*", rows.schema, EVENTS, log, checkpoint)
        stream.awaitTermination()
    return read_log(spark, log)
