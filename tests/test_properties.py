"""Random feeds against a plain Python account of the semantics."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changetrail import HotKeys, TableSpec, change_log, conform, held_rows, incremental_change_log
from changetrail.operators.hot_keys import find_slices
from changetrail.operators.previous import position, versions

SPEC = TableSpec("srv", "db", "tb", ("id", "line"), ("a", "b"), sequence=("n",))
COLUMNS = "Op string, id string, line string, update_ts_dms string, n bigint, a string, b string"
SLICED = HotKeys(rows_per_slice=3, check_above_bytes=0)

value = st.sampled_from([None, "x", "y"])
row = st.tuples(
    st.sampled_from(["I", "U", "D"]),
    st.sampled_from(["1", "1", "1", "2", None]),
    st.sampled_from(["1", None]),
    st.integers(1, 7).map(lambda d: f"2024-01-0{d} 00:00:00" if d < 7 else "no time"),
    value,
    value,
)
# ``n`` numbers the rows, so that no two share a position.
feeds = st.lists(row, min_size=20, max_size=150).map(
    lambda rows: [(*r[:4], (i * 7919) % 1000, *r[4:]) for i, r in enumerate(rows)]
)
few = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def expected(rows, semantics):
    found = Counter()
    if semantics == "strict":
        rows = [r for r in rows if r[3] != "no time"]
    for key in {(r[1], r[2]) for r in rows}:
        before = (None, None)
        for op, _, _, at, n, *now in sorted((r for r in rows if (r[1], r[2]) == key), key=lambda r: (r[3], r[4])):
            pairs = list(zip("ab", now, before))
            if semantics == "strict":
                kept = [(c, v) for c, v, p in pairs if v != p]
            else:
                differs = any(
                    (v is not None and p is not None and v != p) or (p is None and v is not None)
                    for _, v, p in pairs
                )
                kept = [
                    (c, v)
                    for c, v, p in pairs
                    if differs and (p is None or (v is not None and v != p))
                ]
            found.update((op, *key, at, c, v) for c, v in kept)
            before = now
    return found


def actual(log):
    columns = ("Op", "k1", "k2", "updated_at", "column_name", "column_value")
    return Counter(tuple(r) for r in log.select(*columns).collect())


@few
@given(feeds)
def test_change_log_is_what_plain_python_finds(spark, rows):
    feed = conform(spark.createDataFrame(rows, COLUMNS), SPEC)
    for semantics in ("strict", "reference"):
        want = expected(rows, semantics)
        assert actual(change_log(feed, SPEC, semantics, hot=None)) == want
        assert actual(change_log(feed, SPEC, semantics, hot=SLICED)) == want


@few
@given(feeds, st.integers(1, 7))
def test_history_and_increment_make_the_whole(spark, rows, cut_day):
    cut = f"2024-01-0{cut_day} 00:00:00"
    old = spark.createDataFrame([r for r in rows if r[3] < cut], COLUMNS)
    new = spark.createDataFrame([r for r in rows if r[3] >= cut], COLUMNS)
    whole = conform(spark.createDataFrame(rows, COLUMNS), SPEC)
    log = change_log(conform(old, SPEC), SPEC, hot=None)
    for hot in (None, SLICED):
        added = incremental_change_log(conform(new, SPEC), log, SPEC, hot=hot)
        assert actual(log) + actual(added) == expected(rows, "strict")
        assert actual(incremental_change_log(whole, log.unionByName(added), SPEC, hot=hot)) == Counter()


@few
@given(feeds, feeds)
def test_rows_are_logged_held_or_unchanged_on_any_log(spark, old, new):
    """Whatever the log holds, slicing does not change what is added or held back."""
    log = change_log(conform(spark.createDataFrame(old, COLUMNS), SPEC), SPEC, hot=None)
    feed = conform(spark.createDataFrame(new, COLUMNS), SPEC)
    for semantics in ("strict", "reference"):
        plain = incremental_change_log(feed, log, SPEC, semantics, hot=None)
        sliced = incremental_change_log(feed, log, SPEC, semantics, hot=SLICED)
        assert actual(plain) == actual(sliced)
    held = [
        Counter(tuple(r) for r in held_rows(feed, SPEC, log, hot=hot).collect()) for hot in (None, SLICED)
    ]
    assert held[0] == held[1]


def test_one_key_with_most_rows_is_cut(spark, sf_dir):
    """A key with nine tenths of the rows is spread over many slices of like size."""
    from pyspark.sql import functions as F

    spec = TableSpec("srv", "app", "events", ("id",), ("event_type", "value"), sequence=("event_id",))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    feed = events.withColumn("id", F.when(F.col("event_id") % 10 == 0, F.col("user_id")).otherwise(-1))
    conformed = conform(feed.withColumnRenamed("ts", "update_ts_dms"), spec)
    rows = versions(conformed, spec, "strict")
    policy = HotKeys(rows_per_slice=50, check_above_bytes=0)
    slices = find_slices(rows, F.xxhash64("k1"), position(), policy)
    sizes = slices.assign(rows, F.xxhash64("k1"), position()).groupBy("k1", "slice").count().collect()
    hot = [r["count"] for r in sizes if r["k1"] == "-1"]
    assert len(hot) >= 15 and max(hot) < 150
    assert sum(hot) == rows.where("k1 = '-1'").count()
    assert {r["slice"] for r in sizes if r["k1"] != "-1"} == {0}
    plain = change_log(conformed, spec, hot=None)
    for limits in ({}, {"rows_per_slice": 2000}, {"rows_per_slice": 1}, {"samples_per_slice": 2}):
        bounded = HotKeys(**{"rows_per_slice": 50, "check_above_bytes": 0, **limits})
        sliced = change_log(conformed, spec, hot=bounded)
        assert plain.exceptAll(sliced).count() == 0 and sliced.exceptAll(plain).count() == 0


def test_small_inputs_are_not_examined(spark, sf_dir):
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("k1"), "event_id")
    assert find_slices(rows, F.xxhash64("k1"), F.struct("event_id"), HotKeys(rows_per_slice=1)) is None


def test_every_key_above_the_size_is_cut(spark):
    from pyspark.sql import functions as F

    # 3,000 keys of 40 rows and 3,000 of 5
    many = spark.range(3000 * 45).select(
        F.when(F.col("id") < 3000 * 40, F.col("id") % 3000).otherwise(3000 + F.col("id") % 3000).alias("key"),
        F.struct(F.col("id").alias("at")).alias("position"),
    )
    policy = HotKeys(rows_per_slice=10, check_above_bytes=0)
    slices = find_slices(many, F.xxhash64("key"), F.col("position"), policy)
    sizes = slices.assign(many, F.xxhash64("key"), F.col("position")).groupBy("key", "slice").count()
    by_key = {r["large"]: r for r in sizes.groupBy((F.col("key") < 3000).alias("large")).agg(
        F.count("*").alias("slices"), F.max("count").alias("most"), F.sum("count").alias("rows")
    ).collect()}
    assert tuple(by_key[True])[1:] == (3000 * 4, 10, 3000 * 40)
    assert tuple(by_key[False])[1:] == (3000, 5, 3000 * 5)


def test_bounds_of_hot_keys_are_neither_collected_nor_forced_on_tasks(spark):
    from pyspark.sql import functions as F

    rows = spark.range(100_000).select((F.col("id") % 2).alias("key"), F.struct(F.col("id").alias("at")).alias("position"))
    policy = HotKeys(rows_per_slice=5000, check_above_bytes=0)
    slices = find_slices(rows, F.xxhash64("key"), F.col("position"), policy)
    plan = slices.assign(rows, F.xxhash64("key"), F.col("position"))._jdf.queryExecution()
    assert "ResolvedHint" not in plan.analyzed().toString() and "LocalRelation" not in plan.optimizedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = slices.assign(rows, F.xxhash64("key"), F.col("position")).groupBy("key", "slice").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(r["count"] for r in shuffled) == 100_000
    assert 16 <= len(shuffled) <= 26 and max(r["count"] for r in shuffled) < 12_000
