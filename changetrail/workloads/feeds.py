"""The test tables as change feeds, and the folders and logs that queries set up from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.conform import conform
from ..plans.change_log import change_log
from ..plans.sink import append_log
from ..sources import storage
from ..spec import TableSpec

# Where history ends and the new feed begins.
EVENTS_CUT = "2024-01-16"
ORDERS_CUT = "1999-01-01"

EVENTS = TableSpec(
    "prod", "app", "events", ("user_id",), ("event_type", "value", "props"), sequence=("event_id",)
)
# Same rows under a name that has the other as a prefix, and one key per user and type.
EVENTS_X = TableSpec(
    "prod", "app", "events_x", ("user_id", "event_type"), ("value",), sequence=("event_id",)
)
# The same again for a run: an entry that is there twice, one without news, one with too many key columns.
EVENTS_TWICE = TableSpec("prod", "app", "events_twice", ("user_id",), ("event_type",), sequence=("event_id",))
EVENTS_QUIET = TableSpec("prod", "app", "events_quiet", ("user_id",), ("value",), sequence=("event_id",))
EVENTS_BAD = TableSpec(
    "prod", "app", "events_bad", ("user_id", "event_type", "value", "props"), ("ts",), extra_keys="cut"
)
# Nothing tells which of two changes of one instant came first.
FIRST_TYPES = TableSpec("prod", "app", "first_types", ("user_id",), ("event_type",))
# Few keys: each holds a fifth of all rows.
EVENT_TYPES = TableSpec(
    "prod", "ops", "event_types", ("event_type",), ("user_id", "value"), sequence=("event_id",)
)
ORDERS = TableSpec(
    "prod",
    "sales",
    "orders",
    ("o_custkey",),
    ("o_orderstatus", "o_totalprice", "o_orderpriority"),
    sequence=("o_orderkey",),
)
LINEITEM = TableSpec(
    "prod",
    "sales",
    "lineitem",
    ("l_orderkey", "l_linenumber"),
    ("l_quantity", "l_discount", "l_returnflag"),
    sequence=("l_partkey", "l_suppkey"),
)
LINEITEM_FOUR_KEYS = TableSpec(
    "prod",
    "sales",
    "lineitem4",
    ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    ("l_quantity",),
    extra_keys="fold",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts before the cut and updates after, with the user under its source name."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("ts") < EVENTS_CUT, "I").otherwise("U").alias("Op"),
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("ts").alias("update_ts_dms"),
        (F.col("event_id") % 7).cast("string").alias("updated_by_id"),
    )


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose type is null for errors, so that values come and go."""
    return events_feed(spark, sf_dir).withColumn("event_type", F.nullif("event_type", F.lit("error")))


def events_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which an error deletes the user's row."""
    op = F.when(F.col("event_type") == "error", "D").otherwise(F.col("Op"))
    return events_feed(spark, sf_dir).withColumn("Op", op)


def events_partly_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which the time of every error is unreadable."""
    time = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("update_ts_dms").cast("string"))
    return events_feed(spark, sf_dir).withColumn("update_ts_dms", time)


def events_of_one_instant(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Each user's first, second and third event, all at one and the same time."""
    first = W.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, sf_dir, "events").withColumn("place", F.row_number().over(first)).where("place <= 3")
    rows = rows.select(
        F.lit("U").alias("Op"), "user_id", "event_type", "place", F.lit("2024-01-01 00:00:00").alias("update_ts_dms")
    )
    return [rows.where(F.col("place") == place).drop("place") for place in (1, 2, 3)]


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderdate") < ORDERS_CUT, "I").otherwise("U").alias("Op"),
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        F.col("o_orderdate").alias("update_ts_dms"),
        (F.col("o_orderkey") % 5).cast("string").alias("updated_by"),
    )


def lineitem_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed without a user column."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("I").alias("Op"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        "l_returnflag",
        F.col("l_shipdate").alias("update_ts_dms"),
    )


def history(feed: DataFrame, cut: str = EVENTS_CUT) -> DataFrame:
    return feed.where(F.col("update_ts_dms") < cut)


def news(feed: DataFrame, cut: str = EVENTS_CUT) -> DataFrame:
    return feed.where(F.col("update_ts_dms") >= cut)


def stage(feed: DataFrame, folder: str, file_prefix: str) -> None:
    """Write feed files whose names begin with the prefix."""
    feed.write.mode("append").option("mapreduce.output.basename", file_prefix).parquet(folder)


def stage_full_and_daily(spark: SparkSession, sf_dir: str, root: str, specs: tuple[TableSpec, ...]) -> None:
    """History as full-load files, news as the change files of one run date, per table."""
    feed = events_feed(spark, sf_dir)
    for spec in specs:
        stage(history(feed).drop("Op"), f"{root}/{spec.feed_folder}", "LOAD")
        stage(news(feed), f"{root}/{spec.feed_folder}/2024/01/31", "20240131")


def events_log(spark: SparkSession, sf_dir: str, semantics: str = "strict") -> DataFrame:
    """The log of the events' history, not written anywhere."""
    return change_log(conform(history(events_feed(spark, sf_dir)), EVENTS), EVENTS, semantics)


def written_log(spark: SparkSession, sf_dir: str, specs: tuple[TableSpec, ...]) -> str:
    """A new log folder holding the whole change log of each table."""
    path = storage.scratch_folder(spark, "log")
    for spec in specs:
        append_log(change_log(conform(events_feed(spark, sf_dir), spec), spec), path, spec)
    return path
