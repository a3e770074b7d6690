"""Reading and writing a table's state beside the log, by the batches that the log has published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.log_state import baseline
from ..operators.state import BUCKET, STATE_SCHEMA, bucket_of, next_state, seen_versions
from ..sources import storage
from ..sources.batches import Published
from ..spec import TableSpec

#: Bytes of a feed or state for which there is one bucket, and the least and the largest number of buckets.
BUCKET_BYTES = 64 << 20
FEWEST, MOST = 4, 4096


def buckets_for(size: int) -> int:
    """Buckets for a state of about this size, by Catalyst's estimate. It stays until the state has become four times
    too large for it, when all of it is dealt anew."""
    return max(FEWEST, min(MOST, -(-size // BUCKET_BYTES)))


def outgrown(size: int, buckets: int) -> bool:
    return buckets < MOST and size > 4 * BUCKET_BYTES * buckets


def touched_buckets(conformed: DataFrame, buckets: int) -> list[int]:
    """The buckets that a feed's keys fall into; reads the key columns."""
    return sorted(r[BUCKET] for r in conformed.select(bucket_of(buckets).alias(BUCKET)).distinct().collect())


def read_state(
    spark: SparkSession, folder: str, known: Published, buckets: list[int] | None = None
) -> DataFrame:
    """The newest published version of each bucket, or of the named ones."""
    order = {batch.id: batch.number for batch in known.state}
    newest: dict[int, tuple[int, str]] = {}
    for place in storage.matching(spark, f"{folder}/batch=*/{BUCKET}=*"):
        batch, bucket = place.rsplit("/batch=", 1)[1].split(f"/{BUCKET}=")
        if batch in order and (buckets is None or int(bucket) in buckets):
            newest[int(bucket)] = max(newest.get(int(bucket), (-1, "")), (order[batch], batch))
    places = [f"{folder}/batch={batch}/{BUCKET}={bucket}" for bucket, (_, batch) in sorted(newest.items())]
    if not places:
        return spark.createDataFrame([], STATE_SCHEMA)
    rows = spark.read.schema(STATE_SCHEMA).option("basePath", folder).parquet(*places)
    return rows.select(*STATE_SCHEMA.names)


def state_of_log(log: DataFrame, spec: TableSpec) -> DataFrame:
    """What the log alone tells of a table's state: each entity's last logged change. Aggregates the whole table."""
    return seen_versions(baseline(log, spec), spec)


def write_state(
    state: DataFrame, conformed: DataFrame, spec: TableSpec, folder: str, batch: str, buckets: int
) -> None:
    """Write the state after a feed: what was known of the touched buckets, and the feed's last versions."""
    after = next_state(state, seen_versions(conformed, spec), spec)
    dealt = after.withColumn(BUCKET, bucket_of(buckets)).hint("rebalance", BUCKET)
    dealt.write.partitionBy(BUCKET).parquet(f"{folder}/batch={batch}")


__all__ = ["buckets_for", "outgrown", "read_state", "state_of_log", "touched_buckets", "write_state"]
