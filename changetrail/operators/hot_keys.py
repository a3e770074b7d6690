"""Find keys too large for one task and cut them into time slices.

Comparing each version of a row with the one before it needs the versions of one key in
order. A key with a third of all rows would put a third of the data in one task, so such
keys are cut into slices of consecutive versions; a header row carries the last version of
the slice before into each slice (see ``previous.py``). Any cut gives the same result:
the sample below only steers how even the slices are.

There may be any number of such keys and slices: their bounds are a table, found and joined
by Spark, of which the driver sees one number. It is written to the shared folder that
``spark.checkpoint.dir`` names, since a sample drawn again could cut elsewhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources import storage


@dataclass(frozen=True)
class HotKeys:
    """When and how finely to slice.

    Inputs that Catalyst estimates below ``check_above_bytes`` are not examined: no key in
    them can be too large for a task. A slice holds about ``rows_per_slice`` rows, the more evenly
    the larger ``samples_per_slice`` is. A row takes some 600 bytes of the task that compares it, sorted
    and buffered, but may take 25 or fewer of the compressed columns that the estimate goes by.
    """

    rows_per_slice: int = 250_000
    check_above_bytes: int = 16 << 20
    samples_per_slice: int = 20


@dataclass(frozen=True)
class Slices:
    """Slice bounds of the hot keys: a written table, one row a key hash, of any length."""

    table: DataFrame
    most_bounds: int

    def assign(self, rows: DataFrame, key_hash: Column, position: Column, only_hot: bool = False) -> DataFrame:
        """Add ``slice``: how many bounds of the row's key lie at or before its position.

        A binary search over the key's sorted bounds, one column per halving, so that it is
        compiled code and costs some ten comparisons per row. Whether the bounds are sent to every
        task is left to Spark, which knows the written table's size; a shuffled join would have
        its skewed keys split by adaptive execution.
        """
        found = (
            rows.withColumns({"key_hash": key_hash, "position": position})
            .join(self.table, "key_hash", "inner" if only_hot else "left")
            .withColumn("slice", F.lit(0))
        )
        for power in range(self.most_bounds.bit_length() - 1, -1, -1):
            step = 1 << power
            reached = F.get("bounds", F.col("slice") + (step - 1)) <= F.col("position")
            found = found.withColumn("slice", F.col("slice") + F.when(reached, step).otherwise(0))
        return found.drop("key_hash", "position", "bounds")


# Estimates from here on mean that Catalyst knows nothing of the size.
UNKNOWN_BYTES = 1 << 60

# Compressed columns of which one task gets the rows: in its memory they may be more than twenty times as large.
BYTES_PER_TASK = 8 << 20
# Estimates of joins may be far too large; rows are not left out, tasks get more of them.
MOST_PARTITIONS = 1 << 14


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, after partition and column pruning."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def partitions_of(estimate: int, bytes_per_task: int) -> int:
    """Shuffle partitions that rows of this size call for."""
    return min(MOST_PARTITIONS, math.ceil(estimate / bytes_per_task))


def with_enough_partitions(rows: DataFrame, estimate: int, columns: list[str]) -> DataFrame:
    """Deal the rows by the columns into as many partitions as their size calls for.

    Where the session's number is enough, this is left to the operation that follows and to adaptive execution.
    """
    wanted = partitions_of(estimate, BYTES_PER_TASK) if estimate < UNKNOWN_BYTES else 0
    enough = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(wanted, *columns) if wanted > enough else rows


def slice_bounds(rows: DataFrame, key_hash: Column, position: Column, policy: HotKeys) -> DataFrame:
    """``key_hash, bounds`` of every key above ``rows_per_slice``: distinct sorted positions.

    Of each slice, the sample holds about ``samples_per_slice`` rows, so every so many of a key's sampled
    positions in order is a bound, and smaller keys have none. The sample is one shuffle of a few
    millionths of the rows; one key's part of it is ordered by a window that spills.
    """
    rate = min(1.0, policy.samples_per_slice / policy.rows_per_slice)
    step = max(1, round(policy.rows_per_slice * rate))
    sample = rows.sample(rate, seed=17).select(key_hash.alias("key_hash"), position.alias("position"))
    before = F.row_number().over(W.partitionBy("key_hash").orderBy("position")) - 1
    cuts = sample.withColumn("before", before).where((F.col("before") > 0) & (F.col("before") % step == 0))
    return cuts.groupBy("key_hash").agg(F.sort_array(F.collect_set("position")).alias("bounds"))


def find_slices(rows: DataFrame, key_hash: Column, position: Column, policy: HotKeys) -> Slices | None:
    """Return slice bounds for keys above ``rows_per_slice``, or None when there are none."""
    if estimated_bytes(rows) <= policy.check_above_bytes:
        return None
    spark = rows.sparkSession
    bounds = slice_bounds(rows, key_hash, position, policy)
    path = storage.scratch_folder(spark, "hot-keys")
    bounds.write.parquet(path)
    table = spark.read.schema(bounds.schema).parquet(path)
    most = table.agg(F.max(F.size("bounds"))).first()[0]
    return Slices(table, most) if most else None
