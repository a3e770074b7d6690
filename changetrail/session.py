"""Session settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # updated_at text is parsed in, and date folders are cut by, one fixed zone
    "spark.sql.session.timeZone": "UTC",
    # source columns `ID` and `id` are different columns
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size of the files that the rebalanced append writes
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # plans are built from many column expressions; do not record a stack trace for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "changetrail", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
