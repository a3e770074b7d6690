"""Reading the change log and listing what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_table
from ..spec import LOG_SCHEMA, SOURCE, TableSpec
from . import storage
from .batches import LOGGED, published


def read_log(spark: SparkSession, path: str, spec: TableSpec | None = None) -> DataFrame:
    """Open the log, or only one table's folder of it, which spares listing all the others.

    Published batches are read, as they are now: later ones do not show up in the frame. The
    schema is given, so neither footers nor folder names are inspected for types.
    """
    path = path.rstrip("/")
    folders = _table_folders(spark, path) if spec is None else [spec.log_folder]
    targets = [target for folder in folders for target in _logged_folders(spark, f"{path}/{folder}")]
    if not targets:
        return spark.createDataFrame([], LOG_SCHEMA)
    rows = spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*targets)
    return rows.select(*LOG_SCHEMA.names)


def _table_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of all tables, below the log's root."""
    found = storage.matching(spark, f"{path}/rds=*/db=*/tb=*")
    return sorted("/".join(folder.split("/")[-3:]) for folder in found)


def _logged_folders(spark: SparkSession, folder: str) -> list[str]:
    """Folders with log rows in a table's published batches."""
    live = {batch.id for batch in published(spark, folder).live}
    if not live:
        return []
    found = {p.split("/batch=")[-1].split("/")[0] for p in storage.matching(spark, f"{folder}/batch=*/outcome={LOGGED}")}
    return [f"{folder}/batch={batch}/outcome={LOGGED}" for batch in sorted(live & found)]


def table_in_log(spark: SparkSession, path: str, spec: TableSpec) -> bool:
    """Does the log hold this table of this server? Looks at one folder, reads no data."""
    return bool(published(spark, f"{path.rstrip('/')}/{spec.log_folder}").batches)


def load_finished(spark: SparkSession, path: str, spec: TableSpec) -> bool:
    """Has a load of this table ever been completed? Completed loads leave a marker in the table's own folder."""
    folder = f"{path.rstrip('/')}/{spec.log_folder}"
    return table_in_log(spark, path, spec) and storage.exists(spark, f"{folder}/_SUCCESS")


def scan_table(log: DataFrame, spec: TableSpec) -> DataFrame:
    """The log rows of one table; the filter is on partition columns only."""
    return log.where(is_table(spec))


def without_table(log: DataFrame, spec: TableSpec) -> DataFrame:
    """The log as it is after a purge of the table."""
    return log.where(~is_table(spec))


def log_tables(log: DataFrame) -> DataFrame:
    """Tables that rows of a log belong to. Reads partition values, no column data."""
    return log.select(*SOURCE).distinct()


def listed_tables(spark: SparkSession, path: str) -> DataFrame:
    """Tables that a written log holds, by its folders' names: nothing is scanned, one row per table is made."""
    path = path.rstrip("/")
    rows = [
        tuple(part.split("=", 1)[1] for part in folder.split("/"))
        for folder in _table_folders(spark, path)
        if _logged_folders(spark, f"{path}/{folder}")
    ]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in SOURCE))


def log_tables_by_db(tables: DataFrame) -> DataFrame:
    """Tables per database, of a log or of ``listed_tables``; one list is bounded by the number of audited tables."""
    return log_tables(tables).groupBy("db").agg(F.sort_array(F.collect_set("tb")).alias("tables"))
