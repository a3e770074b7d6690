"""Batches that appear as a whole, the state beside the log, changes of one instant, late rows, compaction."""

from __future__ import annotations

import random
import threading
from collections import Counter
from importlib import import_module

import pytest
from pyspark.sql import functions as F

from changetrail import (
    HotKeys,
    TableSpec,
    append_log,
    baseline,
    change_log,
    clean_table,
    compact_table,
    conform,
    incremental_change_log,
    latest_values,
    listed_tables,
    load_feed,
    purge_table,
    read_log,
    table_in_log,
)
from changetrail.operators.previous import versions
from changetrail.plans.change_log import change_log_and_held_rows
from changetrail.plans.table_state import read_state, touched_buckets
from changetrail.sources import storage
from changetrail.sources.batches import ConcurrentLoad, published
from tests.test_plans import count, plan

RUN, DIFF = import_module("changetrail.plans.run"), import_module("changetrail.plans.change_log")
SPEC = TableSpec("eu1", "shop", "carts", ("id", "line"), ("a", "b"), sequence=("n",))
LOOSE = TableSpec("eu1", "shop", "carts", ("id", "line"), ("a", "b"))
COLUMNS = "Op string, id string, line string, update_ts_dms string, n bigint, a string, b string"
SLICED = HotKeys(rows_per_slice=3, check_above_bytes=0)


def feed(spark, rows, spec=SPEC):
    return conform(spark.createDataFrame(rows, COLUMNS).coalesce(2), spec)


def one(value, day, op="U", n=0, key="1", b=None):
    return (op, key, None, f"2024-01-{day:02d} 00:00:00", n, value, b)


def cells(df):
    return Counter(tuple(r) for r in df.select("k1", "k2", "updated_at", "column_name", "column_value").collect())


def values(df):
    """(day, value) of column a in order of time and sequence."""
    rows = df.where("column_name = 'a'").orderBy("updated_at", "seq").collect()
    return [(int(r["updated_at"][8:10]), r["column_value"]) for r in rows]


def random_rows(dice, size, ids="1112", days=20):
    return [
        (
            dice.choice("IUD"),
            dice.choice(ids),
            dice.choice(["1", None]),
            f"2024-01-{dice.randint(1, days):02d} 00:00:00" if dice.random() > 0.05 else "no time",
            n,
            dice.choice(["x", "y", None]),
            dice.choice(["x", "y", None]),
        )
        for n in range(size)
    ]


def test_ten_changes_of_one_instant_are_ten_log_rows(spark, tmp_path):
    """One at a time, by loads (which keep a state) and by the log alone; and again, adding nothing."""
    path, log = str(tmp_path / "log"), None
    rows = [one(f"v{n}", 1) for n in range(10)]
    for part in [[r] for r in rows] + [rows]:
        new = feed(spark, part, LOOSE)
        load_feed(new, LOOSE, path)
        added = incremental_change_log(new, log, LOOSE) if log is not None else change_log(new, LOOSE)
        log = spark.createDataFrame((added if log is None else log.unionByName(added)).collect(), added.schema)
    for own in (read_log(spark, path), log):
        assert values(own) == [(1, f"v{n}") for n in range(10)]
    load_feed(feed(spark, [one("v9", 2)], LOOSE), LOOSE, path)
    assert values(read_log(spark, path))[-1] == (1, "v9")  # the last of the instant is the one to compare with


def test_versions_seen_at_the_last_instant_precede_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    first = [one(v, 1) for v in ("p", "q", "r")]
    load_feed(feed(spark, first, LOOSE), LOOSE, path)
    load_feed(feed(spark, [one("end", 1)], LOOSE), LOOSE, path)
    # read again beside something new: the new one follows "end", whatever the hashes of the others are
    load_feed(feed(spark, [*first, one("end", 2)], LOOSE), LOOSE, path)
    assert len(values(read_log(spark, path))) == 4
    for hot in (None, SLICED):
        added = load_feed(feed(spark, [*first, *[one(f"w{n}", 3) for n in range(9)]], LOOSE), LOOSE, path, hot=hot)
        assert added["changes"] == (9 if hot is None else 0)
        assert added["feed_rows"] == 12


def test_loads_do_not_read_the_log_and_rewrite_touched_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RUN, "buckets_for", lambda size: 64)
    path = str(tmp_path / "log")
    load_feed(feed(spark, [one("x", 1, key=str(k)) for k in range(200)]), SPEC, path)
    before = published(spark, f"{path}/{SPEC.log_folder}")
    assert before.state and before.buckets == 64
    few = feed(spark, [one("y", 2, key="5"), one("y", 2, key="7")])
    touched = touched_buckets(few, 64)
    state = read_state(spark, f"{path}_state/{SPEC.log_folder}", before, touched)
    assert 2 <= state.count() < 30

    text = plan(change_log_and_held_rows(few, SPEC, state=state))
    assert "Aggregate" not in text.replace("HashAggregate(keys=[key", "") and count("Window", text) == 1
    assert f"{path}/" not in text and f"{path}_state/" in text
    assert all(f"bucket={b}" in text or len(touched) > 1 for b in touched)
    for name in ("state_of_log", "read_log"):
        monkeypatch.setattr(RUN, name, None)
    assert load_feed(few, SPEC, path)["changes"] == 2
    monkeypatch.undo()
    written = {p.name for p in (tmp_path / "log_state").rglob("batch=*/bucket=*")}
    last = published(spark, f"{path}/{SPEC.log_folder}").batches[-1]
    newest = {p.name for p in (tmp_path / "log_state").rglob(f"batch={last.id}/bucket=*")}
    assert newest == {f"bucket={b}" for b in touched} < written
    # a state that has become too large for its buckets is dealt anew, all of it
    monkeypatch.setattr(RUN, "outgrown", lambda size, buckets: buckets < 90)
    monkeypatch.setattr(RUN, "buckets_for", lambda size: 90)
    for day in (3, 4):
        assert load_feed(feed(spark, [one("z", day, key="5"), one("x", 9, key="8")]), SPEC, path)["changes"] == 4 - day
    known = published(spark, f"{path}/{SPEC.log_folder}")
    assert known.buckets == 90 and [b.kind for b in known.batches] == ["full64", "load", "full90", "load"]
    assert read_state(spark, f"{path}_state/{SPEC.log_folder}", known).count() == 200


def test_increments_make_the_whole_log(spark, tmp_path):
    """Rows in order of time, load by load, whatever was seen unchanged in between."""
    rows, path = random_rows(random.Random(0), 150), str(tmp_path / "log")
    for first, last in ((1, 5), (6, 6), (7, 20)):
        part = [r for r in rows if r[3] == "no time" or first <= int(r[3][8:10]) <= last]
        for hot in (None, SLICED):  # each twice
            load_feed(feed(spark, part), SPEC, path, hot=hot)
    assert cells(read_log(spark, path)) == cells(change_log(feed(spark, rows), SPEC))


@pytest.mark.parametrize("seed", [1])
def test_repaired_logs_end_in_what_is_true(spark, tmp_path, seed):
    """Rows in any order over several loads: the log ends as one load of all would, and has all of its values."""
    dice = random.Random(seed)
    rows = random_rows(dice, 90, days=28)
    dice.shuffle(rows)
    path = str(tmp_path / "log")
    for part in (rows[:30], rows[30:60], rows[60:], rows[10:70]):
        load_feed(feed(spark, part), SPEC, path, late="repair")
    whole = change_log(feed(spark, rows), SPEC)

    def ends(log):
        found = {(r["k1"], r["k2"], r["column_name"]): r["column_value"] for r in latest_values(log).collect()}
        return {k: v for k, v in found.items() if v is not None}

    assert ends(read_log(spark, path)) == ends(whole)
    # versions that were unchanged when they were seen, and are not any more, are known when they are read again
    for expected in (lambda n: True, lambda n: n == 0):
        assert expected(load_feed(feed(spark, rows), SPEC, path, late="repair")["changes"])
        log = cells(read_log(spark, path))
        assert not cells(whole) - log and ends(read_log(spark, path)) == ends(whole)


def test_a_late_row_does_not_end_the_log(spark, tmp_path):
    """x, x again (not logged), and then, late, y in between."""
    for late, want in (("hold", [(1, "x")]), ("repair", [(1, "x"), (3, "y"), (5, "x")])):
        path = str(tmp_path / late)
        load_feed(feed(spark, [one("x", 1), one("x", 5)]), SPEC, path)
        counts = load_feed(feed(spark, [one("y", 3)]), SPEC, path, late=late)
        assert values(read_log(spark, path)) == want
        assert (counts["behind_rows"], counts["changes"]) == (1, len(want) - 1)
        held = spark.read.parquet(f"{path}_held/{SPEC.log_folder}").collect()
        assert [(r["reason"], r["a"]) for r in held] == [("behind", "y")]
    with pytest.raises(ValueError):
        load_feed(feed(spark, [one("x", 1)]), SPEC, path, late="drop")


def test_one_comparison_gives_log_and_held_rows(spark, tmp_path, monkeypatch):
    """Both come from one job; the diff is not run again for what is held back."""
    path, calls = str(tmp_path / "log"), []
    plain = DIFF.compare
    monkeypatch.setattr(DIFF, "compare", lambda *a, **k: calls.append(1) or plain(*a, **k))
    load_feed(feed(spark, [one("x", 5)]), SPEC, path)
    late = [one("y", 3), one("z", 6), ("U", "1", None, "soon", 1, "q", None)]
    counts = load_feed(feed(spark, late), SPEC, path)
    assert len(calls) == 2
    assert (counts["feed_rows"], counts["changes"], counts["behind_rows"], counts["undated_rows"]) == (3, 1, 1, 1)
    assert values(read_log(spark, path)) == [(5, "x"), (6, "z")]


def test_a_load_cut_short_is_not_seen_and_its_repetition_is_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    load_feed(feed(spark, [one("x", 1)]), SPEC, path)
    batch = feed(spark, [one("y", 2), one("z", 3), one("w", 4)])

    def fail(*_):
        raise RuntimeError("cut short")

    for step in ("write_state", "publish"):
        monkeypatch.setattr(RUN, step, fail)
        with pytest.raises(RuntimeError, match="cut short"):
            load_feed(batch, SPEC, path)
        monkeypatch.undo()
        assert values(read_log(spark, path)) == [(1, "x")]
    # part of what a failed load left is gone
    left = [p for p in (tmp_path / "log").rglob("*.parquet") if "daypart=3" in str(p)]
    left[0].unlink()
    assert load_feed(batch, SPEC, path)["changes"] == 3
    assert values(read_log(spark, path)) == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]
    assert load_feed(batch, SPEC, path)["changes"] == 0


def test_state_and_log_are_written_side_by_side(spark, tmp_path, monkeypatch):
    began, plain_state, plain_log = threading.Event(), RUN.write_state, RUN.write_log
    waited = []
    monkeypatch.setattr(RUN, "write_state", lambda *a: began.set() or plain_state(*a))
    monkeypatch.setattr(RUN, "write_log", lambda *a: waited.append(began.wait(30)) or plain_log(*a))
    path = str(tmp_path / "log")
    assert load_feed(feed(spark, [one("x", 1)]), SPEC, path)["changes"] == 1
    assert waited == [True] and values(read_log(spark, path)) == [(1, "x")]


def test_of_two_loads_side_by_side_the_second_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    load_feed(feed(spark, [one("x", 1)]), SPEC, path)
    plain = RUN.write_state

    def other_first(*args):
        monkeypatch.setattr(RUN, "write_state", plain)
        load_feed(feed(spark, [one("y", 2)]), SPEC, path)
        plain(*args)

    monkeypatch.setattr(RUN, "write_state", other_first)
    with pytest.raises(ConcurrentLoad):
        load_feed(feed(spark, [one("z", 3)]), SPEC, path)
    assert values(read_log(spark, path)) == [(1, "x"), (2, "y")]
    assert load_feed(feed(spark, [one("z", 3)]), SPEC, path)["changes"] == 1


def test_rows_appended_without_state_are_taken_from_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    load_feed(feed(spark, [one("x", 1)]), SPEC, path)
    append_log(change_log(feed(spark, [one("y", 2)]), SPEC).where("column_name = 'a'"), path, SPEC)
    assert not published(spark, f"{path}/{SPEC.log_folder}").state
    assert load_feed(feed(spark, [one("y", 3)]), SPEC, path)["changes"] == 0
    known = published(spark, f"{path}/{SPEC.log_folder}")
    assert known.state and len(known.batches) == 3
    assert load_feed(feed(spark, [one("w", 2), one("z", 4)]), SPEC, path)["behind_rows"] == 1


def test_compaction_makes_fewer_files_and_the_same_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for day in range(1, 6):
        load_feed(feed(spark, [one(f"v{n}", 1 + day // 4, n=day * 10 + n, key=str(n)) for n in range(4)]), SPEC, path)
    append_log(change_log(feed(spark, [one("q", 9, key="q")]), LOOSE), path, LOOSE)
    load_feed(feed(spark, [one("r", 9, key="r")]), SPEC, path)
    reader = read_log(spark, path)  # has listed its files before
    before, rows = len(reader.inputFiles()), cells(reader)
    assert compact_table(spark, path, SPEC) == 7
    after = read_log(spark, path, SPEC)
    assert len(after.inputFiles()) < before and cells(after) == rows == cells(reader)
    assert len({f.rsplit("/", 1)[0] for f in after.inputFiles()}) == len(after.inputFiles())
    assert compact_table(spark, path, SPEC) == 0
    # the state goes on from before, and is not taken from the log again
    assert published(spark, f"{path}/{SPEC.log_folder}").state
    assert load_feed(feed(spark, [one("r", 10, key="r")]), SPEC, path)["changes"] == 0
    assert clean_table(spark, path, SPEC) == 0  # too young
    assert clean_table(spark, path, SPEC, older_than_hours=0) > 7
    assert cells(read_log(spark, path)) == rows
    assert load_feed(feed(spark, [one("s", 11, key="r"), one("v1", 11, key="1")]), SPEC, path)["changes"] == 1


def test_purge_takes_the_state_along(spark, tmp_path):
    path = str(tmp_path / "log")
    load_feed(feed(spark, [one("x", 1)]), SPEC, path)
    other = TableSpec("eu1", "shop", "carts_x", ("id",), ("a",))
    append_log(change_log(feed(spark, [one("x", 1)]), SPEC).withColumn("tb", F.lit("carts_x")), path)
    assert [r["tb"] for r in listed_tables(spark, path).orderBy("tb").collect()] == ["carts", "carts_x"]
    assert purge_table(spark, path, SPEC) and not storage.exists(spark, f"{path}_state/{SPEC.log_folder}")
    assert not table_in_log(spark, path, SPEC) and table_in_log(spark, path, other)
    assert load_feed(feed(spark, [one("x", 1)]), SPEC, path)["action"] == "initial"


def test_tables_are_listed_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    load_feed(feed(spark, [one("x", 1)]), SPEC, path)
    text = plan(listed_tables(spark, path))
    assert "FileScan" not in text and "Scan parquet" not in text


def test_content_hashes_say_nothing_of_what_was_first(spark):
    """Baseline rows of tables without ``sequence`` come before all others of their instant."""
    log = change_log(feed(spark, [one("x", 1)], LOOSE), LOOSE)
    row = versions(baseline(log, LOOSE), LOOSE, "strict").first()
    assert row["change_order"] == "" and row["logged"]["change_order"]
