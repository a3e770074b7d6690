"""The state of a table: one row per entity, its version seen last.

The log alone tells what was last *logged*, and only by aggregating all of it. The state tells
what was last *seen*, changed or not, and is dealt into buckets by a hash of the key, so an
increment reads and rewrites the buckets that its keys fall into and nothing of the log.

``ties`` serves tables without ``sequence``: the contents (hashes) of all versions seen at the entity's last
instant. What is among them has been read before; anything else at that instant is new, whatever its hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column, generation_after, plain_content
from ..spec import FROM_LOG, KEYS, MICROS, OP, ORDER, TIME, USER, TableSpec

BUCKET = "bucket"
STATE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in KEYS]
    + [
        T.StructField("at", T.LongType()),
        T.StructField(ORDER, T.StringType()),
        T.StructField("ties", T.ArrayType(T.StringType())),
        T.StructField(OP, T.StringType()),
        T.StructField(TIME, T.StringType()),
        T.StructField(USER, T.StringType()),
        T.StructField("now", T.MapType(T.StringType(), T.StringType())),
    ]
)
_VERSION = (OP, TIME, USER, "now")


def bucket_of(buckets: int) -> Column:
    """The bucket of an entity; its key columns are text."""
    return F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int")


def seen_versions(conformed: DataFrame, spec: TableSpec) -> DataFrame:
    """The dated rows of a conformed frame, or of ``baseline``, in the state's shape."""
    names = F.array(*[F.lit(name) for name in spec.audit_columns])
    values = F.array(*[column(name) for name in spec.audit_columns])
    content = F.array(plain_content(F.coalesce(F.col(ORDER), F.lit(""))))
    return conformed.where(F.col(MICROS).isNotNull()).select(
        *KEYS,
        F.col(MICROS).alias("at"),
        ORDER,
        (F.lit(None).cast("array<string>") if spec.sequence else content).alias("ties"),
        OP,
        TIME,
        USER,
        F.map_from_arrays(names, values).alias("now"),
    )


def next_state(state: DataFrame, seen: DataFrame, spec: TableSpec) -> DataFrame:
    """The state after versions have been seen: each entity's last one.

    With ``sequence`` this is one partial aggregation. Without, an entity's versions at its last instant are ranked
    first, which keeps those of one instant only, before the shuffle too.
    """
    if spec.sequence:
        both = state.unionByName(seen)
        last = F.max_by(F.struct("at", ORDER, "ties", *_VERSION), F.struct("at", ORDER))
        return both.groupBy(*KEYS).agg(last.alias("last")).select(*KEYS, "last.*")
    # what is seen at the known instant follows what was known of it
    rows = state.withColumn("known", F.lit(True)).unionByName(seen.withColumn("known", F.lit(False)))
    newest = W.partitionBy(*KEYS).orderBy(F.col("at").desc())
    rows = rows.withColumn("rank", F.rank().over(newest)).where("rank = 1")
    prior = F.max(F.when(F.col("known"), F.struct(ORDER, "ties"))).over(W.partitionBy(*KEYS))
    rows = rows.withColumn("prior", prior)
    again = ~F.col("known") & F.coalesce(F.array_contains("prior.ties", F.element_at("ties", 1)), F.lit(False))
    order = F.when(F.col("known") | F.col("prior").isNull(), F.col(ORDER)).otherwise(
        generation_after(F.col("prior").getField(ORDER), F.col(ORDER))
    )
    last = F.max_by(F.struct("at", ORDER, *_VERSION), F.struct("at", ORDER))
    ties = F.array_sort(F.array_distinct(F.flatten(F.collect_set("ties"))))
    return (
        rows.where(~again)
        .withColumn(ORDER, order)
        .groupBy(*KEYS)
        .agg(last.alias("last"), ties.alias("ties"))
        .select(*KEYS, "last.*", "ties")
        .select(*STATE_SCHEMA.names)
    )


def state_as_baseline(state: DataFrame, spec: TableSpec, feed: DataFrame, emit_deletes: bool) -> DataFrame:
    """The state of the feed's entities in the shape of ``versions``, to compare the feed with."""
    keys = F.struct(*KEYS).alias("key")
    known = state.select(keys, "*").join(feed.select(keys).distinct(), "key", "left_semi")
    values = [F.col("now").getItem(name).alias(name) for name in spec.audit_columns]
    if emit_deletes:
        kept = ~F.col(OP).eqNullSafe("D")
        values = [F.when(kept, F.col("now").getItem(name)).alias(name) for name in spec.audit_columns]
    none = F.lit(None).cast("string")
    return known.select(
        *KEYS,
        OP,
        none.alias(TIME),
        none.alias(USER),
        "at",
        (F.col(ORDER) if spec.sequence else F.lit("")).alias(ORDER),
        F.lit(True).alias(FROM_LOG),
        F.struct("at", ORDER, "ties").alias("logged"),
        F.struct(*values).alias("now"),
    )
