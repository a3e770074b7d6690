"""Small feeds with known answers: nulls, baselines, replays, keys, names and deletes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changetrail import (
    TableSpec,
    baseline,
    change_log,
    conform,
    held_rows,
    incremental_change_log,
    pivot_log,
    without_table,
)
from changetrail.spec import LOG_SCHEMA

AB = TableSpec("srv", "db", "tb", ("id",), ("a", "b"))
# Change times in order.
T1, T2, T3, T4 = (f"2024-01-0{n} 00:00:00" for n in range(1, 5))


def feed(spark, rows, columns="Op string, id string, update_ts_dms string, a string, b string"):
    return spark.createDataFrame(rows, columns)


def cells(df, *extra):
    return sorted(
        [tuple(r) for r in df.select("k1", "updated_at", "column_name", "column_value", *extra).collect()],
        key=str,
    )


def log_of(spark, rows, spec=AB):
    """Log rows from (key, time, column, value)."""
    full = [
        ("I", k, None, None, t, None, v, None, spec.rds, spec.db, spec.tb, c, 2024, 1, 1) for k, t, c, v in rows
    ]
    return spark.createDataFrame(full, LOG_SCHEMA)


NULL_RULES = [
    ("I", "1", T1, "a", None),
    ("U", "1", T2, "a", "x"),
    ("U", "1", T3, None, "x"),
    ("U", "1", T4, "a", "x"),
    ("I", "2", T1, None, None),
    ("U", "2", T2, "b", None),
]


def test_null_rules_reference(spark):
    log = change_log(conform(feed(spark, NULL_RULES), AB), AB, "reference", keep_previous=True)
    assert "seq" not in log.columns
    assert cells(log, "previous_value") == sorted(
        [
            ("1", T1, "a", "a", None),
            ("1", T1, "b", None, None),
            ("1", T2, "b", "x", None),
            ("1", T4, "a", "a", None),
            ("2", T2, "a", "b", None),
            ("2", T2, "b", None, None),
        ],
        key=str,
    )


def test_null_rules_strict(spark):
    log = change_log(conform(feed(spark, NULL_RULES), AB), AB, keep_previous=True)
    assert cells(log, "previous_value") == sorted(
        [
            ("1", T1, "a", "a", None),
            ("1", T2, "b", "x", None),
            ("1", T3, "a", None, "a"),
            ("1", T4, "a", "a", None),
            ("2", T2, "a", "b", None),
        ],
        key=str,
    )


def test_baseline_of_columns_that_changed_apart(spark):
    log = log_of(spark, [("1", T1, "a", "10"), ("1", T1, "b", "5"), ("1", T2, "b", "6")])
    new = conform(feed(spark, [("U", "1", T3, "10", "7")]), AB)
    row = baseline(log, AB, "reference").first()
    assert (row["updated_at"], row["a"], row["b"]) == (T2, None, "6")
    row = baseline(log, AB).first()
    assert (row["updated_at"], row["a"], row["b"]) == (T2, "10", "6")
    assert cells(incremental_change_log(new, log, AB, "reference")) == [("1", T3, "a", "10"), ("1", T3, "b", "7")]
    assert cells(incremental_change_log(new, log, AB)) == [("1", T3, "b", "7")]


def test_replay(spark):
    spec = TableSpec("srv", "db", "tb", ("id",), ("a",))
    log = log_of(spark, [("1", T2, "a", "20")], spec)
    again = conform(feed(spark, [("U", "1", T1, "10", None), ("U", "1", T2, "20", None)]), spec)
    assert cells(incremental_change_log(again, log, spec, "reference")) == [("1", T1, "a", "10")]
    assert cells(incremental_change_log(again, log, spec)) == []
    held = held_rows(again, spec, log).collect()
    assert [(r["reason"], r["k1"], r["updated_at"], r["a"]) for r in held] == [("behind", "1", T1, "10")]


def test_replay_of_equal_times_without_sequence(spark):
    rows = [("I", "1", T1, "x", None), ("U", "1", T1, "y", None), ("U", "1", T1, "z", "q"), ("U", "1", T2, "z", "q")]
    new = conform(feed(spark, rows), AB)
    log = change_log(new, AB).cache()
    assert log.count() > 0
    assert incremental_change_log(new, log, AB).count() == 0


def test_single_and_missing_keys(spark):
    row = conform(feed(spark, [("I", "7", T1, "a", "b")]), AB).first()
    assert (row["k1"], row["k2"], row["k3"]) == ("7", None, None)


def test_null_key_is_an_entity(spark):
    log = log_of(spark, [(None, T1, "a", "1")])
    new = conform(feed(spark, [("U", None, T2, "1", "z"), ("U", None, T3, "2", "z")]), AB)
    assert cells(incremental_change_log(new, log, AB)) == [(None, T2, "b", "z"), (None, T3, "a", "2")]


def test_more_than_three_keys(spark):
    keys = ("a", "b", "c", "d")
    frame = spark.createDataFrame([("1", "2", "3", "4", T1, "v")], "a string, b string, c string, d string, update_ts_dms string, x string")
    with pytest.raises(ValueError):
        TableSpec("srv", "db", "tb", keys, ("x",))
    cut = conform(frame, TableSpec("srv", "db", "tb", keys, ("x",), extra_keys="cut")).first()
    assert (cut["k1"], cut["k2"], cut["k3"]) == ("1", "2", "3")
    fold = conform(frame, TableSpec("srv", "db", "tb", keys, ("x",), extra_keys="fold")).first()
    assert (fold["k1"], fold["k2"], fold["k3"]) == ("1", "2", '["3","4"]')


def test_bad_time(spark):
    frame = conform(feed(spark, [("I", "1", "bad", "z", "b"), ("I", "1", T1, "a", "b")]), AB)
    parts = {r["updated_at"]: (r["yearpart"], r["monthpart"], r["daypart"]) for r in frame.collect()}
    assert parts == {"bad": (None, None, None), T1: (2024, 1, 1)}
    assert {r[1] for r in cells(change_log(frame, AB))} == {T1}
    assert [(r["reason"], r["updated_at"]) for r in held_rows(frame, AB).collect()] == [("undated", "bad")]
    assert "bad" in {r[1] for r in cells(change_log(frame, AB, "reference"))}


def test_names_need_no_care(spark):
    spec = TableSpec("srv", "db", "tb", ("the id",), ("a-b", "c.d", "prev_a-b", "seq"))
    frame = spark.createDataFrame(
        [("1", T1, "x", "y", "z", 1), ("1", T2, "x2", "y", "z", 2)],
        "`the id` string, update_ts_dms string, `a-b` string, `c.d` string, `prev_a-b` string, seq int",
    )
    got = cells(change_log(conform(frame, spec), spec))
    assert ("1", T2, "a-b", "x2") in got and ("1", T2, "seq", "2") in got and len(got) == 6


def test_audited_key(spark):
    spec = TableSpec("srv", "db", "tb", ("id",), ("id", "a"))
    got = cells(change_log(conform(feed(spark, [("I", "1", T1, "x", None)]), spec), spec))
    assert got == [("1", T1, "a", "x"), ("1", T1, "id", "1")]


def test_user_columns(spark):
    base = spark.createDataFrame([("1", T1, "x")], "id string, update_ts_dms string, a string")
    spec = TableSpec("srv", "db", "tb", ("id",), ("a",))
    assert conform(base, spec).first()["updated_by"] is None
    assert conform(base.withColumn("updated_by", F.lit("u")), spec).first()["updated_by"] == "u"
    both = base.withColumn("updated_by", F.lit("u")).withColumn("updated_by_id", F.lit(9))
    assert conform(both, spec).first()["updated_by"] == "9"


def test_added_audited_column(spark):
    wide = TableSpec("srv", "db", "tb", ("id",), ("a", "c"))
    log = log_of(spark, [("1", T1, "a", "x"), ("1", T1, "b", "gone")])
    old = conform(feed(spark, [("U", "1", T2, "x", "y")]), wide)
    assert cells(incremental_change_log(old, log, wide)) == []
    frame = feed(spark, [("U", "1", T2, "x", "y")]).withColumn("c", F.lit("new"))
    assert cells(incremental_change_log(conform(frame, wide), log, wide)) == [("1", T2, "c", "new")]


def test_deletes(spark):
    rows = [("I", "1", T1, "x", None), ("D", "1", T2, "x", None), ("D", "1", T3, "x", None), ("I", "1", T4, "x", "y")]
    frame = conform(feed(spark, rows), AB)
    assert {r[1] for r in cells(change_log(frame, AB))} == {T1, T4}
    got = cells(change_log(frame, AB, emit_deletes=True))
    assert got == sorted(
        [("1", T1, "a", "x"), ("1", T2, "a", None), ("1", T2, "b", None), ("1", T4, "a", "x"), ("1", T4, "b", "y")],
        key=str,
    )
    log = change_log(frame, AB, emit_deletes=True)
    assert incremental_change_log(frame, log, AB, emit_deletes=True).count() == 0
    with pytest.raises(ValueError):
        change_log(frame, AB, "reference", emit_deletes=True)


def test_times_are_ordered_as_times_in_strict(spark):
    rows = [("I", "1", "2024-01-02 9:00:00", "x", None), ("U", "1", "2024-01-02 10:00:00", "y", None)]
    frame = conform(feed(spark, rows), AB)
    strict = change_log(frame, AB, keep_previous=True).where("column_value = 'y'").first()
    assert strict["previous_value"] == "x"
    reference = change_log(frame, AB, "reference", keep_previous=True).where("column_value = 'x'").first()
    assert reference["previous_value"] == "y"


def test_integer_sequence_is_ordered_as_numbers(spark):
    spec = TableSpec("srv", "db", "tb", ("id",), ("a",), sequence=("n",))
    frame = spark.createDataFrame(
        [("1", T1, "x", -5), ("1", T1, "y", 9), ("1", T1, "z", 10), ("1", T1, "w", None)],
        "id string, update_ts_dms string, a string, n bigint",
    )
    log = change_log(conform(frame, spec), spec, keep_previous=True)
    assert {(r["column_value"], r["previous_value"]) for r in log.collect()} == {
        ("w", None),
        ("x", "w"),
        ("y", "x"),
        ("z", "y"),
    }
    with pytest.raises(ValueError):
        bad = TableSpec("srv", "db", "tb", ("id",), ("a",), sequence=("f",))
        conform(frame.withColumn("f", F.lit(1.0)), bad)


def test_decimal_sequence_is_ordered_as_numbers(spark):
    spec = TableSpec("srv", "db", "tb", ("id",), ("a",), sequence=("n",))
    rows = [("-10.50", "p"), ("-9.99", "q"), ("-0.01", "r"), ("0.00", "s"), ("9.5", "t"), ("10", "u"), ("999.99", "v")]
    frame = spark.createDataFrame([("1", T1, a, n) for n, a in rows], "id string, update_ts_dms string, a string, n string")
    frame = frame.withColumn("n", F.col("n").cast("decimal(5,2)"))
    log = change_log(conform(frame, spec), spec, keep_previous=True).collect()
    found = {r["column_value"]: r["previous_value"] for r in log}
    assert found == {b: a for a, b in zip([None, *"pqrstu"], "pqrstuv")}


def test_pivot_names_absent_columns(spark):
    log = log_of(spark, [("1", T1, "a", "x")])
    row = pivot_log(log, ("a", "never")).first()
    assert (row["a"], row["never"]) == ("x", None)


def test_purge_view_is_exact(spark):
    orders = TableSpec("srv", "db", "orders", ("id",), ("a",))
    orders_x = TableSpec("srv", "db", "orders_x", ("id",), ("a",))
    log = log_of(spark, [("1", T1, "a", "x")], orders).unionByName(log_of(spark, [("2", T1, "a", "y")], orders_x))
    assert [r["tb"] for r in without_table(log, orders).collect()] == ["orders_x"]


@pytest.mark.parametrize(
    "change",
    [
        {"primary_key": ()},
        {"primary_key": ("",)},
        {"primary_key": ""},
        {"audit_columns": ()},
        {"audit_columns": ("a", "a")},
        {"audit_columns": ("k1",)},
        {"tb": "a/b"},
        {"db": ""},
        {"extra_keys": "ignore"},
    ],
)
def test_bad_specs(change):
    good = dict(rds="srv", db="db", tb="tb", primary_key=("id",), audit_columns=("a",))
    TableSpec(**good)
    with pytest.raises(ValueError):
        TableSpec(**{**good, **change})


def test_feed_must_have_keys_and_time(spark):
    frame = spark.createDataFrame([("1", "x")], "id string, a string")
    with pytest.raises(ValueError, match="update_ts_dms"):
        conform(frame, AB)
    with pytest.raises(ValueError, match="nope"):
        conform(frame.withColumn("update_ts_dms", F.lit(T1)), TableSpec("srv", "db", "tb", ("nope",), ("a",)))
