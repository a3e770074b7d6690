"""Incremental feeds as a file stream: every new file is processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.conform import conform
from ..operators.hot_keys import HotKeys
from ..plans.run import HOLD, load_feed
from ..spec import STRICT, TableSpec


def stream_change_log(
    spark: SparkSession,
    feed_path: str,
    feed_schema: T.StructType,
    spec: TableSpec,
    log_path: str,
    checkpoint: str,
    *,
    held_path: str | None = None,
    state_path: str | None = None,
    late: str = HOLD,
    emit_deletes: bool = False,
    hot: HotKeys | None = HotKeys(),
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process the files that are new since the last run, then stop.

    The log and the table's state beside it are the only state, so nothing grows in the stream. A
    batch that is repeated after a failure finds nothing of an attempt that did not publish, or all of one that
    did, and then adds nothing. ``feed_path``
    may hold globs, for instance ``<root>/<db>/<tb>/*/*/*`` for dated folders.

    All new files are one batch, in which versions are put in order whatever file they came in.
    With ``max_files_per_batch``, rows that arrive in a later batch than newer ones of their
    entity are late; like other late rows they are kept under ``held_path`` (by default
    ``<log_path>_held``), and with ``late="repair"`` also put into their place in the log.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_feed(
            batch,
            spec,
            log_path,
            STRICT,
            held_path=held_path,
            state_path=state_path,
            late=late,
            emit_deletes=emit_deletes,
            hot=hot,
        )

    reader = spark.readStream.schema(feed_schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    files = reader.parquet(feed_path)
    # conformed before the batches are cut, so that only needed columns are read
    return (
        conform(files, spec)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
