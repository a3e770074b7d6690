"""Writing the change log: batches that become visible as a whole, purge, compaction and clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import storage
from ..sources.batches import LOGGED, PLAIN, WHOLE, new_id, publish, published
from ..sources.log import read_log
from ..spec import LOG_PARTITIONS, SOURCE, TableSpec

_IN_BATCH = [c for c in LOG_PARTITIONS if c not in SOURCE]


def append_log(
    cells: DataFrame, path: str, spec: TableSpec | None = None, counts: Observation | None = None
) -> None:
    """Append change rows as one batch, partitioned by table, column and day.

    Rows are rebalanced by partition: small partitions become one file, and a partition with
    much of the data (a full load on one day) is split over tasks instead of filling one.
    With ``spec``, the rows are written into that table's own folder, so tables can be
    appended side by side without sharing an output folder. Readers see all of the batch or,
    should the write end half-way, nothing of it; then append again. Without ``spec`` that
    holds for each table. ``counts`` observes ``changes``, in the stage that writes, so tasks
    that are run again are not counted twice.
    """
    path, spark, batch = path.rstrip("/"), cells.sparkSession, new_id()
    if spec is not None:
        folder = f"{path}/{spec.log_folder}"
        since = published(spark, folder)
        write_log(cells.drop(*SOURCE), f"{folder}/batch={batch}/outcome={LOGGED}", _IN_BATCH, counts)
        publish(spark, folder, since, batch, PLAIN)
        return
    columns = [*SOURCE, "batch", "outcome", *_IN_BATCH]
    write_log(cells.withColumns({"batch": F.lit(batch), "outcome": F.lit(LOGGED)}), path, columns, counts)
    for written in storage.matching(spark, f"{path}/rds=*/db=*/tb=*/batch={batch}"):
        folder = f"{path}/{'/'.join(written.split('/')[-4:-1])}"
        publish(spark, folder, published(spark, folder), batch, PLAIN)


def write_log(rows: DataFrame, folder: str, columns: list[str], counts: Observation | None = None) -> None:
    """Write rebalanced rows below a folder, by partition columns."""
    rows = rows.hint("rebalance", *columns)
    if counts is not None:
        logged = F.col("outcome") == LOGGED if "outcome" in rows.columns else F.lit(True)
        rows = rows.observe(counts, F.count_if(logged).alias("changes"))
    rows.write.mode("append").partitionBy(*columns).parquet(folder)


def state_root(log_path: str) -> str:
    """Where the state of a log's tables lies unless another place is named."""
    return f"{log_path.rstrip('/')}_state"


def purge_table(spark: SparkSession, path: str, spec: TableSpec, state_path: str | None = None) -> bool:
    """Delete exactly this table's folder from the log, and its state; False when there is none."""
    gone = storage.delete(spark, f"{path.rstrip('/')}/{spec.log_folder}")
    # without the log's markers nothing of the state counts any more
    storage.delete(spark, f"{(state_path or state_root(path)).rstrip('/')}/{spec.log_folder}")
    return gone


def compact_table(spark: SparkSession, path: str, spec: TableSpec) -> int:
    """Rewrite the files of a table's batches as one batch, one file for each column and day unless that would be
    too large; returns how many batches were replaced.

    The new batch is published as the old ones' replacement, in the one step that publishes
    any batch: a reader sees the old files or the new ones, never both. Files of readers that have begun stay
    until ``clean_table``.
    """
    folder = f"{path.rstrip('/')}/{spec.log_folder}"
    since, batch = published(spark, folder), new_id()
    live = since.live
    if len(live) < 2:
        return 0
    rows = read_log(spark, path, spec).drop(*SOURCE)
    write_log(rows, f"{folder}/batch={batch}/outcome={LOGGED}", _IN_BATCH)
    # rows that came without state still lack it after being rewritten
    kind = WHOLE if since.state or not any(b.kind == PLAIN for b in live) else PLAIN
    publish(spark, folder, since, batch, kind, tuple(b.id for b in live))
    return len(live)


def clean_table(
    spark: SparkSession, path: str, spec: TableSpec, older_than_hours: float = 72, state_path: str | None = None
) -> int:
    """Delete batches that no reader sees: replaced by compaction, or never published, and versions of the state that
    newer ones replace; none written within ``older_than_hours``, so that readers and loads that are under way keep
    theirs. Returns how many folders were deleted."""
    folder = f"{path.rstrip('/')}/{spec.log_folder}"
    state = f"{(state_path or state_root(path)).rstrip('/')}/{spec.log_folder}"
    known = published(spark, folder)
    live = {b.id for b in known.live}
    old = [p for p in storage.matching(spark, f"{folder}/batch=*") if p.rsplit("batch=", 1)[1] not in live]
    order = {b.id: b.number for b in known.state}
    versions = storage.matching(spark, f"{state}/batch=*/bucket=*")
    newest: dict[str, int] = {}
    for place in versions:
        batch, bucket = place.rsplit("/batch=", 1)[1].split("/bucket=")
        newest[bucket] = max(newest.get(bucket, -1), order.get(batch, -1))
    for place in versions:
        batch, bucket = place.rsplit("/batch=", 1)[1].split("/bucket=")
        if order.get(batch, -1) < newest[bucket] or batch not in order:
            old.append(place)
    deleted = 0
    for place in old:
        if storage.age_seconds(spark, place) >= 3600 * older_than_hours:
            deleted += storage.delete(spark, place)
    return deleted
