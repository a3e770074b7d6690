"""Helpers that the operators share: reading tables, cutting lineage, bounded batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources import storage

#: Rows and bytes of text that one Arrow batch hands to Python at most (a row is never split).
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since texts may be very long."""
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        spark.conf.set(key, str(value))


def tidy(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable:
    """The same function of batches, after which a task hands freed memory back to the system.

    A Python worker lives on and serves other tasks. What its allocators keep for later would be counted with theirs.
    """

    def tidied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return tidied


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Lineage is cut there: what follows does not repeat the work before it, and a lost executor
    loses nothing, as the files are in the folder that ``spark.checkpoint.dir`` names.
    """
    spark = frame.sparkSession
    path = storage.scratch_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the folder of a frame that ``saved`` returned, once nothing will read it again."""
    files = frame.inputFiles()
    if files:
        storage.delete(frame.sparkSession, files[0].rsplit("/", 1)[0])
