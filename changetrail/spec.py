"""What is audited: one immutable description per source table, and the log's schema."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Names used by feeds, by the conformed frame and by the change log.
OP = "Op"
FEED_TIME = "update_ts_dms"
TIME = "updated_at"
FEED_USER = "updated_by_id"
USER = "updated_by"
SOURCE = ("rds", "db", "tb")
KEYS = ("k1", "k2", "k3")
ENTITY = SOURCE + KEYS
DATE_PARTS = ("yearpart", "monthpart", "daypart")
FROM_LOG = "from_log"
ORDER = "change_order"
MICROS = "change_micros"
CONFORMED = (OP, *ENTITY, TIME, USER, FROM_LOG, *DATE_PARTS, MICROS, ORDER)
LOG_PARTITIONS = (*SOURCE, "column_name", *DATE_PARTS)
LOG_COLUMNS = (OP, *ENTITY, TIME, USER, *DATE_PARTS, "column_name", "column_value")

LOG_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (OP, *KEYS, TIME, USER, "column_value", "seq")]
    + [T.StructField(name, T.StringType()) for name in (*SOURCE, "column_name")]
    + [T.StructField(name, T.IntegerType()) for name in DATE_PARTS]
)

STRICT = "strict"
REFERENCE = "reference"

# Characters that Spark escapes in partition folder names, or that globs interpret.
_UNSAFE_IN_FOLDER = re.compile(r"[\x00-\x1f\"#%'*/:=?\\{}\[\]^\x7f]")


def check_semantics(semantics: str) -> str:
    if semantics not in (STRICT, REFERENCE):
        raise ValueError(f"semantics must be '{STRICT}' or '{REFERENCE}', not {semantics!r}")
    return semantics


@dataclass(frozen=True)
class TableSpec:
    """One audited source table.

    ``sequence`` names feed columns (non-floating) that order changes of one key with equal
    time, and must tell them apart; without it a hash of the row's content does both. ``extra_keys`` says what to do with
    more than three key columns: ``reject`` them, ``fold`` the tail into ``k3`` as a JSON
    array, or ``cut`` them off (which may merge distinct entities).
    """

    rds: str
    db: str
    tb: str
    primary_key: tuple[str, ...]
    audit_columns: tuple[str, ...]
    is_delete: bool = False
    sequence: tuple[str, ...] = ()
    extra_keys: str = "reject"

    def __post_init__(self) -> None:
        for field in ("primary_key", "audit_columns", "sequence"):
            value = getattr(self, field)
            if isinstance(value, str):
                raise ValueError(f"{field} must be a list of column names, not text")
            object.__setattr__(self, field, tuple(value or ()))
        for field in SOURCE:
            value = getattr(self, field)
            if not value or _UNSAFE_IN_FOLDER.search(value):
                raise ValueError(f"{field}={value!r} cannot name a partition folder")
        if self.is_delete:
            return
        if not self.primary_key or not all(self.primary_key):
            raise ValueError(f"{self.name}: at least one key column is needed")
        if not self.audit_columns or not all(self.audit_columns):
            raise ValueError(f"{self.name}: at least one audited column is needed")
        if len(set(self.audit_columns)) != len(self.audit_columns):
            raise ValueError(f"{self.name}: an audited column is listed twice")
        reserved = set(CONFORMED).intersection(self.audit_columns)
        if reserved:
            raise ValueError(f"{self.name}: audited columns {sorted(reserved)} use reserved names")
        if self.extra_keys not in ("reject", "fold", "cut"):
            raise ValueError(f"{self.name}: extra_keys must be reject, fold or cut")
        if len(self.primary_key) > len(KEYS) and self.extra_keys == "reject":
            raise ValueError(f"{self.name}: more than {len(KEYS)} key columns")

    @property
    def name(self) -> str:
        return ".".join((self.rds, self.db, self.tb))

    @property
    def source(self) -> dict[str, str]:
        return {"rds": self.rds, "db": self.db, "tb": self.tb}

    @property
    def log_folder(self) -> str:
        """Partition folder of this table below the log's root."""
        return "/".join(f"{column}={value}" for column, value in self.source.items())

    @property
    def feed_folder(self) -> str:
        return f"{self.db}/{self.tb}"
