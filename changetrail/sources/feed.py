"""Feeds of a source table: full load, history and daily change files."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import file_kind
from ..spec import FEED_TIME, OP, TableSpec
from . import storage

# Folder names of the feed layout.
FULL_LOAD_FOLDER = "FullLoad_Files"
OLD_CDC_FOLDER = "OldCdc_Files"


def dated_paths(root: str, run_date: date, days: int = 1) -> list[str]:
    """Day folders of the ``days`` days before the run date, oldest first; 0 is the run date."""
    if days < 0:
        raise ValueError("days must not be negative")
    offsets = range(days, 0, -1) if days else [0]
    return [f"{root.rstrip('/')}/{run_date - timedelta(days=n):%Y/%m/%d}" for n in offsets]


def with_file_kind(feed: DataFrame) -> DataFrame:
    """Add ``file_kind`` (full, cdc or skip) from the name of the file each row came from."""
    return feed.withColumn("file_kind", file_kind(F.col("_metadata.file_name")))


def read_feed(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    mode: str = "incremental",
    *,
    run_date: date | None = None,
    days: int = 0,
    merge_schema: bool = True,
) -> DataFrame:
    """Read one source table's files below ``root``.

    ``incremental``: the dated folders of the window, those that exist. ``full``: files named
    ``LOAD*`` in the table's folder, as inserts. ``historical``: the full-load folder, as
    inserts, and the old change files. Files of one folder may differ in columns;
    ``merge_schema=False`` skips reading every footer where they are known not to.
    """
    folder = f"{root.rstrip('/')}/{spec.feed_folder}"
    reader = spark.read.option("mergeSchema", merge_schema)
    if mode == "incremental":
        if run_date is None:
            raise ValueError("an incremental read needs a run date")
        paths = [p for p in dated_paths(folder, run_date, days) if storage.exists(spark, p)]
        return reader.parquet(*paths) if paths else _no_rows(spark, spec)
    if mode == "full":
        return _as_inserts(reader.option("pathGlobFilter", "LOAD*").parquet(folder))
    if mode == "historical":
        full = _as_inserts(reader.parquet(f"{folder}/{FULL_LOAD_FOLDER}"))
        changes = reader.parquet(f"{folder}/{OLD_CDC_FOLDER}")
        return full.unionByName(changes, allowMissingColumns=True)
    raise ValueError(f"unknown feed mode {mode!r}")


def _as_inserts(feed: DataFrame) -> DataFrame:
    return feed.withColumn(OP, F.lit("I"))


def _no_rows(spark: SparkSession, spec: TableSpec) -> DataFrame:
    names = dict.fromkeys([OP, *spec.primary_key, *spec.audit_columns, *spec.sequence, FEED_TIME])
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.createDataFrame([], schema)
