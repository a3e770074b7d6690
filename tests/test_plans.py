"""What the plans must look like for the library to hold up at scale."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from changetrail import (
    HotKeys,
    append_log,
    baseline,
    change_log,
    conform,
    incremental_change_log,
    latest_values,
    pivot_log,
    read_log,
    scan_table,
)
from changetrail.functions import in_date_window
from changetrail.operators import hot_keys
from changetrail.workloads.feeds import EVENTS, ORDERS, events_feed, history, news, orders_feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(node: str, text: str) -> int:
    return len(re.findall(rf"^[\s:+-]*(?:\*\(\d+\) )?{node}\b", text, flags=re.M))


@pytest.fixture(scope="module")
def written(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    append_log(change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS), path, EVENTS)
    append_log(change_log(conform(orders_feed(spark, sf_dir).where("o_custkey < 5"), ORDERS), ORDERS), path, ORDERS)
    return path


def test_diff_is_one_window_over_one_exchange(spark, sf_dir):
    for semantics in ("strict", "reference"):
        text = plan(change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS, semantics))
        assert count("Window", text) == 1
        assert count("Exchange", text) == 1
        assert "Python" not in text


@pytest.mark.parametrize("semantics", ["strict", "reference"])
def test_tasks_do_not_grow_with_the_feed(spark, sf_dir, monkeypatch, semantics):
    feed = conform(orders_feed(spark, sf_dir), ORDERS)
    expected = sorted(pivot_log(change_log(feed, ORDERS, semantics), ORDERS.audit_columns).collect(), key=str)
    monkeypatch.setattr(hot_keys, "BYTES_PER_TASK", 2000)
    pivoted = pivot_log(change_log(feed, ORDERS, semantics), ORDERS.audit_columns)
    dealt = re.findall(r"hashpartitioning\(k1#\d+, (\d+)\), REPARTITION_BY_NUM", plan(pivoted))
    assert len(dealt) == 1 and int(dealt[0]) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert count("Exchange", plan(pivoted)) == 1
    assert sorted(pivoted.collect(), key=str) == expected


def test_keys_that_would_fill_a_task_are_cut(spark):
    rows = spark.range(0, 700_000, 1, 4).select(F.lit("a").alias("k1"), F.struct("id").alias("at"))
    slices = hot_keys.find_slices(rows, F.xxhash64("k1"), F.col("at"), HotKeys(check_above_bytes=0))
    assert slices is not None and slices.most_bounds >= 1


def test_only_needed_columns_are_read(spark, sf_dir):
    spec_columns = {"event_id", "ts", "user_id", "event_type", "value", "props"}
    text = plan(change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert [{c.split(":")[0] for c in r.split(",")} for r in read] == [spec_columns]
    lean = plan(conform(events_feed(spark, sf_dir), EVENTS).select("k1"))
    assert "ReadSchema: struct<user_id:bigint>" in lean


def test_values_are_shuffled_once_per_row(spark, sf_dir):
    """The window's inputs are columns of the exchange, not copies of them."""
    text = plan(change_log(conform(events_feed(spark, sf_dir), EVENTS), EVENTS))
    assert "_w0" not in text


def test_incremental_plan(spark, written, sf_dir):
    feed = conform(news(events_feed(spark, sf_dir)), EVENTS)
    text = plan(incremental_change_log(feed, read_log(spark, written, EVENTS), EVENTS))
    assert count("Window", text) == 1
    # the feed's keys are small here, so the log is reduced before it is aggregated
    assert text.index("SortAggregate") < text.index("BroadcastHashJoin")
    assert "LeftSemi" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_incremental_plan_with_many_keys(spark, written, sf_dir):
    """Too many keys to broadcast: the semi join reuses the aggregation's partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed = conform(news(events_feed(spark, sf_dir)), EVENTS)
        text = plan(baseline(read_log(spark, written, EVENTS), EVENTS, feed=feed))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert count("Exchange", text) == 2


def test_log_scan_is_pruned(spark, written):
    text = plan(scan_table(read_log(spark, written), EVENTS).where("column_name = 'value' and daypart = 3"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    for name in ("rds", "db", "tb", "column_name", "daypart"):
        assert name in filters
    assert "DataFilters: []" in text


def test_baseline_reads_audited_columns_only(spark, written):
    narrow = baseline(read_log(spark, written), EVENTS)
    assert re.search(r"PartitionFilters: \[[^\]]*column_name", plan(narrow))


def test_top_one_is_limited_before_the_exchange(spark, written):
    text = plan(latest_values(read_log(spark, written)))
    assert re.findall(r"row_number\(\), 1, (\w+)", text) == ["Final", "Partial"]
    assert count("Exchange", text) == 1


def test_pivot_runs_no_job_to_find_its_columns(spark, sf_dir):
    log = change_log(conform(orders_feed(spark, sf_dir), ORDERS), ORDERS, "reference")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    text = plan(pivot_log(log, ORDERS.audit_columns))
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "partial_max" in text


def test_date_window_reaches_the_scan(spark, sf_dir):
    feed = events_feed(spark, sf_dir).where(in_date_window(F.col("update_ts_dms"), date(2024, 1, 21), 3))
    assert "GreaterThanOrEqual(ts,2024-01-18" in plan(feed)
    assert "LessThan(ts,2024-01-21" in plan(feed)


def test_append_rebalances(spark, sf_dir, tmp_path):
    cells = change_log(conform(history(events_feed(spark, sf_dir)), EVENTS), EVENTS)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(cells.hint("rebalance", "column_name", "daypart"))
    append_log(cells, str(tmp_path / "log"))
    files = list((tmp_path / "log").rglob("*.parquet"))
    folders = {f.parent for f in files}
    assert len(files) == len(folders), "a small partition is one file"


def test_one_large_day_is_written_by_many_tasks(spark, sf_dir, tmp_path):
    """All changes on one day: the partition is split, not written by one task."""
    feed = events_feed(spark, sf_dir).withColumn("update_ts_dms", F.lit("2024-01-01 00:00:00"))
    cells = change_log(conform(feed, EVENTS), EVENTS, "reference")
    # partitions as small as the data, so that there is more than one to write from
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        append_log(cells, str(tmp_path / "log"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    by_folder: dict = {}
    for file in (tmp_path / "log").rglob("*.parquet"):
        by_folder.setdefault(file.parent, []).append(file)
    assert max(len(files) for files in by_folder.values()) > 1
