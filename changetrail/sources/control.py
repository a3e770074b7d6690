"""The control table: which source tables and columns are audited."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..spec import TableSpec

CONTROL_SCHEMA = (
    "rds_name string, rds_instance_type string, db_name string, tb_name string, "
    "primaryKey array<string>, audit_column array<string>, IsDelete boolean, sequence array<string>, "
    "extra_keys string"
)


def control_table(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read table entries from a JSON array (or from JSON lines), filling optional fields.

    ``sequence``, which orders changes of equal time, and ``extra_keys``, which says what becomes of key columns beyond
    the third, are optional fields of our own.
    """
    raw = spark.read.schema(CONTROL_SCHEMA).option("multiLine", multi_line).json(path)
    none = F.array().cast("array<string>")
    return raw.withColumns(
        {
            "primaryKey": F.coalesce("primaryKey", none),
            "audit_column": F.coalesce("audit_column", none),
            "IsDelete": F.coalesce("IsDelete", F.lit(False)),
            "sequence": F.coalesce("sequence", none),
            "extra_keys": F.coalesce("extra_keys", F.lit("reject")),
        }
    )


def to_purge(control: DataFrame) -> DataFrame:
    return control.where("IsDelete")


def to_process(control: DataFrame) -> DataFrame:
    return control.where("not IsDelete")


def historical_tables(control: DataFrame, selector: str) -> DataFrame:
    """Add ``is_historical``: is the table listed in the selector, JSON ``{db: [tables]}``."""
    listed = F.from_json(F.lit(selector), "map<string,array<string>>")
    tables = F.try_element_at(listed, F.col("db_name"))
    return control.withColumn(
        "is_historical", F.coalesce(F.array_contains(tables, F.col("tb_name")), F.lit(False))
    )


def spec_of(row: Row) -> TableSpec:
    """The spec of one control row; raises ValueError where the row makes no valid one."""
    return TableSpec(
        rds=row["rds_name"],
        db=row["db_name"],
        tb=row["tb_name"],
        primary_key=row["primaryKey"],
        audit_columns=row["audit_column"],
        is_delete=row["IsDelete"],
        sequence=row["sequence"],
        extra_keys=row["extra_keys"] if "extra_keys" in row else "reject",
    )


def control_rows(control: DataFrame) -> list[Row]:
    """Collect the control rows, one small row per table."""
    flagged = control if "is_historical" in control.columns else control.withColumn("is_historical", F.lit(False))
    return flagged.collect()


def specs(control: DataFrame) -> list[tuple[TableSpec, bool]]:
    """Collect the control rows as (spec, is_historical)."""
    return [(spec_of(row), row["is_historical"]) for row in control_rows(control)]
