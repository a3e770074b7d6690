"""Feeds, control tables, the written log, whole runs and the stream."""

from __future__ import annotations

import importlib
import json
from datetime import date

import pytest

from changetrail import (
    TableSpec,
    append_log,
    change_log,
    conform,
    control_table,
    dated_paths,
    historical_tables,
    load_feed,
    log_tables,
    purge_table,
    read_feed,
    read_log,
    run,
    stream_change_log,
    table_in_log,
)
from changetrail.sources import storage, to_process, to_purge
from changetrail.sources.control import specs
from changetrail.sources.log import load_finished
from changetrail.workloads.feeds import stage

DAY = date(2024, 1, 31)
SALES = TableSpec("eu1", "shop", "invoices", ("id",), ("amount",))
SAMPLE = [
    {
        "rds_name": "eu1",
        "rds_instance_type": "postgres",
        "db_name": "stock",
        "tb_name": "shelves",
        "primaryKey": ["id"],
        "audit_column": ["height"],
    },
    {
        "rds_name": "eu1",
        "rds_instance_type": "postgres",
        "db_name": "shop",
        "tb_name": "invoices",
        "primaryKey": ["id"],
        "audit_column": ["amount"],
    },
]


def write_control(tmp_path, entries):
    path = tmp_path / "control.json"
    path.write_text(json.dumps(entries, indent=2))
    return str(path)


def orders(spark, rows, columns="id int, amount double, update_ts_dms string"):
    return spark.createDataFrame(rows, columns).coalesce(1)


def cells(df):
    return sorted((r["k1"], r["Op"], r["column_name"], r["column_value"]) for r in df.collect())


def by_table(report):
    return {r["tb"]: r for r in report.collect()}


def test_dated_paths():
    assert dated_paths("s://b/db/tb/", DAY, 0) == ["s://b/db/tb/2024/01/31"]
    assert dated_paths("s://b/db/tb", date(2024, 3, 1), 2) == ["s://b/db/tb/2024/02/28", "s://b/db/tb/2024/02/29"]
    with pytest.raises(ValueError):
        dated_paths("x", DAY, -1)


def test_control_table_defaults(spark, tmp_path):
    path = write_control(tmp_path, [*SAMPLE, {"rds_name": "r", "db_name": "d", "tb_name": "t", "IsDelete": True}])
    control = control_table(spark, path)
    rows = {r["tb_name"]: r for r in control.collect()}
    assert rows["invoices"]["IsDelete"] is False and rows["t"]["primaryKey"] == []
    assert [r["tb_name"] for r in to_purge(control).collect()] == ["t"]
    assert to_process(control).count() == 2
    flags = {r["tb_name"]: r["is_historical"] for r in historical_tables(control, '{"shop": ["invoices"]}').collect()}
    assert flags == {"shelves": False, "invoices": True, "t": False}
    assert [(s.tb, h) for s, h in specs(historical_tables(to_process(control), "{}"))] == [
        ("shelves", False),
        ("invoices", False),
    ]


def test_control_entries_may_fold_keys(spark, tmp_path):
    many = {
        "rds_name": "eu2",
        "rds_instance_type": "mysql",
        "db_name": "crm",
        "tb_name": "visits",
        "primaryKey": ["shop", "day", "desk", "ticket"],
        "audit_column": ["clerk", "outcome", "note"],
        "sequence": ["entry"],
        "extra_keys": "fold",
    }
    gone = {"rds_name": "eu2", "db_name": "crm", "tb_name": "leads", "IsDelete": True}
    found = {spec.tb: spec for spec, _ in specs(control_table(spark, write_control(tmp_path, [many, gone])))}
    assert (found["visits"].extra_keys, found["visits"].sequence) == ("fold", ("entry",))
    assert found["leads"].is_delete and found["leads"].extra_keys == "reject"


def test_incremental_read_takes_the_folders_there_are(spark, tmp_path):
    root = str(tmp_path)
    stage(orders(spark, [(1, 1.0, "a")]), f"{root}/shop/invoices/2024/01/29", "20240129")
    stage(orders(spark, [(2, 2.0, "b")]), f"{root}/shop/invoices/2024/01/31", "20240131")
    def read(**options):
        return sorted(r["id"] for r in read_feed(spark, root, SALES, run_date=DAY, **options).collect())
    assert read() == [2]
    assert read(days=5) == [1]
    assert read_feed(spark, root, SALES, run_date=date(2023, 1, 1)).count() == 0
    with pytest.raises(ValueError):
        read_feed(spark, root, SALES)
    with pytest.raises(ValueError):
        read_feed(spark, root, SALES, "sideways")


def test_files_of_one_day_may_differ_in_columns(spark, tmp_path):
    day = f"{tmp_path}/shop/invoices/2024/01/31"
    stage(orders(spark, [(1, 1.0, "a")]), day, "20240131-a")
    stage(spark.createDataFrame([(2, "b", 9)], "id int, update_ts_dms string, updated_by_id int").coalesce(1), day, "20240131-b")
    frame = conform(read_feed(spark, str(tmp_path), SALES, run_date=DAY), SALES)
    got = {(r["k1"], r["amount"], r["updated_by"]) for r in frame.collect()}
    assert got == {("1", "1.0", None), ("2", None, "9")}


def test_full_load_takes_load_files_as_inserts(spark, tmp_path):
    folder = f"{tmp_path}/shop/invoices"
    stage(orders(spark, [(1, 1.0, "a")]), folder, "LOAD0001")
    stage(orders(spark, [(2, 1.0, "a")]), folder, "LOOSE")
    stage(orders(spark, [(3, 1.0, "a")]), f"{folder}/2024/01/31", "20240131")
    rows = read_feed(spark, str(tmp_path), SALES, "full").collect()
    assert [(r["Op"], r["id"]) for r in rows] == [("I", 1)]


def test_log_folder_of_one_table(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path).count() == 0 and not table_in_log(spark, path, SALES)
    frame = conform(orders(spark, [(1, 1.0, "2024-01-01 00:00:00")]), SALES)
    append_log(change_log(frame, SALES), path)
    like = TableSpec("1", "2", "3", ("id",), ("amount",))
    append_log(change_log(conform(orders(spark, [(1, 1.0, "2024-01-01 00:00:00")]), like), like), path, like)
    assert sorted(tuple(r) for r in log_tables(read_log(spark, path)).collect()) == [
        ("1", "2", "3"),
        ("eu1", "shop", "invoices"),
    ]
    assert read_log(spark, path, like).first()["rds"] == "1"
    assert purge_table(spark, path, like) and not purge_table(spark, path, like)
    assert read_log(spark, path).count() == 1


def test_same_names_on_two_servers_are_two_tables(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = conform(orders(spark, [(1, 1.0, "2024-01-01 00:00:00")]), SALES)
    append_log(change_log(frame, SALES), path, SALES)
    assert not table_in_log(spark, path, TableSpec("other", "shop", "invoices", ("id",), ("amount",)))


def test_runs(spark, tmp_path):
    root, log, held = (str(tmp_path / n) for n in ("feed", "log", "held"))
    control = control_table(spark, write_control(tmp_path, SAMPLE))
    stage(
        orders(spark, [(1, 5.0, "2024-01-01 00:00:00"), (2, 6.0, "2024-01-01 00:00:00")]),
        f"{root}/shop/invoices",
        "LOAD0001",
    )

    first = by_table(run(spark, control, root, log, DAY, held_path=held))
    assert (first["invoices"]["action"], first["invoices"]["status"], first["invoices"]["feed_rows"]) == ("initial", "done", 2)
    assert first["shelves"]["status"] == "failed" and first["shelves"]["error"]
    assert cells(read_log(spark, log)) == [("1", "I", "amount", "5.0"), ("2", "I", "amount", "6.0")]

    nothing = by_table(run(spark, control, root, log, DAY, held_path=held, last_only=True))
    assert list(nothing) == ["invoices"] and nothing["invoices"]["status"] == "empty"

    changes = [
        ("U", 1, 6.5, "2024-01-30 00:00:00"),
        ("U", 1, 7.0, "2024-01-31 00:00:00"),
        ("U", 2, 6.0, "2024-01-31 00:00:00"),
        ("U", 2, 1.0, "2023-01-01 00:00:00"),
        ("U", 2, 2.0, "soon"),
    ]
    columns = "Op string, id int, amount double, update_ts_dms string"
    stage(orders(spark, changes, columns), f"{root}/shop/invoices/2024/01/31", "20240131")
    second = by_table(run(spark, control, root, log, DAY, held_path=held, last_only=True))["invoices"]
    assert (second["action"], second["feed_rows"], second["changes"]) == ("incremental", 5, 2)
    assert (second["behind_rows"], second["undated_rows"]) == (1, 1)
    assert sorted(r["reason"] for r in spark.read.parquet(f"{held}/{SALES.log_folder}").collect()) == ["behind", "undated"]
    assert ("1", "U", "amount", "7.0") in cells(read_log(spark, log))

    third = by_table(run(spark, control, root, log, DAY, last_only=True))["invoices"]
    assert (third["status"], third["feed_rows"], third["changes"]) == ("done", 5, 0)

    gone = control.where("tb_name = 'invoices'").selectExpr("* except (IsDelete)", "true as IsDelete")
    assert by_table(run(spark, gone, root, log, DAY))["invoices"]["action"] == "purge"
    assert not table_in_log(spark, log, SALES)


def test_a_first_load_cut_short_is_read_in_full_again(spark, tmp_path):
    root, log = str(tmp_path / "feed"), str(tmp_path / "log")
    control = control_table(spark, write_control(tmp_path, SAMPLE[1:]))
    rows = [(1, 5.0, "2024-01-01 00:00:00"), (2, 6.0, "2024-01-02 00:00:00")]
    stage(orders(spark, rows), f"{root}/shop/invoices", "LOAD0001")
    part = conform(orders(spark, rows[:1]), SALES)
    append_log(change_log(part, SALES), log, SALES)
    (tmp_path / "log" / SALES.log_folder / "_SUCCESS").unlink()
    report = by_table(run(spark, control, root, log, DAY))["invoices"]
    assert (report["feed_rows"], report["changes"]) == (2, 1)
    assert [c[0] for c in cells(read_log(spark, log))] == ["1", "2"]


def test_run_in_reference_semantics_logs_again_what_it_reads_again(spark, tmp_path):
    root, log = str(tmp_path / "feed"), str(tmp_path / "log")
    control = control_table(spark, write_control(tmp_path, SAMPLE[1:]))
    stage(orders(spark, [(1, 5.0, "2024-01-01 00:00:00")]), f"{root}/shop/invoices", "LOAD0001")
    rows = [("U", 1, 6.0, "2024-01-02 00:00:00"), ("U", 1, 7.0, "2024-01-03 00:00:00")]
    columns = "Op string, id int, amount double, update_ts_dms string"
    stage(orders(spark, rows, columns), f"{root}/shop/invoices/2024/01/31", "20240131")
    added = [
        by_table(run(spark, control, root, log, DAY, semantics="reference"))["invoices"]["changes"] for _ in range(3)
    ]
    assert added == [1, 2, 1]


def test_settings_are_left_as_they_were(spark, tmp_path):
    names = ("spark.sql.adaptive.optimizer.excludedRules", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(name, None) for name in names]
    frame = conform(orders(spark, [(1, 5.0, "2024-01-01 00:00:00")]), SALES)
    load_feed(frame, SALES, str(tmp_path / "log"))
    assert [spark.conf.get(name, None) for name in names] == before


def test_partitions_follow_the_size(spark, sf_dir, monkeypatch):
    runs = importlib.import_module("changetrail.plans.run")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert runs.partitions_for(events) == 1
    monkeypatch.setattr(runs, "_BYTES_PER_PARTITION", 1000)
    assert 10 < runs.partitions_for(events) < runs.partitions_for(events, events)


def test_stream_processes_each_file_once(spark, tmp_path):
    root, log, checkpoint = (str(tmp_path / n) for n in ("feed", "log", "checkpoint"))
    columns = "Op string, id int, amount double, update_ts_dms string"
    first = orders(spark, [("I", 1, 5.0, "2024-01-01 00:00:00")], columns)
    schema = first.schema

    def drain(where):
        stream_change_log(spark, f"{root}/*/*/*", schema, SALES, log, where).awaitTermination()
        return cells(read_log(spark, log))

    stage(first, f"{root}/2024/01/01", "20240101")
    assert drain(checkpoint) == [("1", "I", "amount", "5.0")]
    assert drain(checkpoint) == [("1", "I", "amount", "5.0")]
    stage(orders(spark, [("U", 1, 6.0, "2024-01-02 00:00:00")], columns), f"{root}/2024/01/02", "20240102")
    both = [("1", "I", "amount", "5.0"), ("1", "U", "amount", "6.0")]
    assert drain(checkpoint) == both
    # a lost checkpoint makes every file new again; the log shows that they were processed
    assert drain(str(tmp_path / "other")) == both


def test_scratch_folder_is_in_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert storage.scratch_folder(spark, "x").startswith(f"{shared}/x-")


def test_a_bad_row_and_a_repeated_table_do_not_harm_a_run(spark, tmp_path):
    root, log = str(tmp_path / "feed"), str(tmp_path / "log")
    bad = {**SAMPLE[1], "tb_name": "keys", "primaryKey": ["a", "b", "c", "d"]}
    control = control_table(spark, write_control(tmp_path, [bad, SAMPLE[1], SAMPLE[1], SAMPLE[1]]))
    stage(orders(spark, [(1, 5.0, "2024-01-01 00:00:00")]), f"{root}/shop/invoices", "LOAD0001")
    report = run(spark, control, root, log, DAY).collect()
    assert [r["tb"] for r in report] == ["keys", "invoices", "invoices", "invoices"]
    assert report[0]["status"] == "failed" and "key" in report[0]["error"]
    assert [r["changes"] for r in report[1:]] == [1, 0, 0]
    assert len(cells(read_log(spark, log))) == 1


def test_held_rows_are_kept_beside_the_log_by_default(spark, tmp_path):
    log = str(tmp_path / "log")
    for moment, value in (("2024-01-02 00:00:00", 2.0), ("2024-01-01 00:00:00", 1.0)):
        load_feed(conform(orders(spark, [(1, value, moment)]), SALES), SALES, log)
    held = spark.read.parquet(f"{log}_held/{SALES.log_folder}").collect()
    assert [(r["reason"], r["amount"]) for r in held] == [("behind", "1.0")]
    assert len(cells(read_log(spark, log))) == 1


def test_a_marker_of_the_whole_log_does_not_finish_a_table(spark, tmp_path):
    log = tmp_path / "log"
    part = conform(orders(spark, [(1, 5.0, "2024-01-01 00:00:00")]), SALES)
    append_log(change_log(part, SALES), str(log), SALES)
    (log / SALES.log_folder / "_SUCCESS").unlink()
    (log / "_SUCCESS").touch()
    assert not load_finished(spark, str(log), SALES)
