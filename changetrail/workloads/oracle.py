"""SQL counterparts of the registered queries, in the dialect of DuckDB.

They state each result directly over the tables and share no code with the library: what the
library reads back from files or logs is here one SELECT.
"""

from __future__ import annotations

_TIES = "'1' || lpad(cast({0} AS VARCHAR), 19, '0')"


def _order(*columns: str) -> str:
    return " || chr(1) || ".join(_TIES.format(c) for c in columns)


_DATED = """
    cast(year({moment}) AS INTEGER) AS yearpart, cast(month({moment}) AS INTEGER) AS monthpart,
    cast(day({moment}) AS INTEGER) AS daypart"""

# One row per version: source identity, key, position and audited values as text.
_EVENT_FIELDS = f"""
    CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'I' ELSE 'U' END AS "Op",
    ts AS moment, cast(ts AS VARCHAR) AS updated_at, cast(event_id % 7 AS VARCHAR) AS updated_by,
    {_order('event_id')} AS seq"""


def _events(op: str | None = None, event_type: str = "event_type") -> str:
    fields = _EVENT_FIELDS
    if op:
        fields = fields.replace("""CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'I' ELSE 'U' END AS "Op\"""", f'{op} AS "Op"')
    return f"""SELECT {fields}, 'prod' AS rds, 'app' AS db, 'events' AS tb,
    cast(user_id AS VARCHAR) AS k1, cast(NULL AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3,
    {event_type} AS event_type, cast(value AS VARCHAR) AS value, props FROM events"""


EVENTS = _events()
EVENTS_WITH_GAPS = _events(event_type="nullif(event_type, 'error')")
EVENTS_X = f"""SELECT {_EVENT_FIELDS}, 'prod' AS rds, 'app' AS db, 'events_x' AS tb,
    cast(user_id AS VARCHAR) AS k1, event_type AS k2, cast(NULL AS VARCHAR) AS k3,
    cast(value AS VARCHAR) AS value FROM events"""
EVENT_TYPES = f"""SELECT {_EVENT_FIELDS}, 'prod' AS rds, 'ops' AS db, 'event_types' AS tb,
    event_type AS k1, cast(NULL AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3,
    cast(user_id AS VARCHAR) AS user_id, cast(value AS VARCHAR) AS value FROM events"""
EVENTS_TWICE = f"""SELECT {_EVENT_FIELDS}, 'prod' AS rds, 'app' AS db, 'events_twice' AS tb,
    cast(user_id AS VARCHAR) AS k1, cast(NULL AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3, event_type FROM events"""
EVENTS_QUIET = f"""SELECT {_EVENT_FIELDS}, 'prod' AS rds, 'app' AS db, 'events_quiet' AS tb,
    cast(user_id AS VARCHAR) AS k1, cast(NULL AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3,
    cast(value AS VARCHAR) AS value FROM events"""
ORDERS = f"""SELECT
    CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'I' ELSE 'U' END AS "Op",
    o_orderdate AS moment, cast(o_orderdate AS VARCHAR) AS updated_at,
    cast(o_orderkey % 5 AS VARCHAR) AS updated_by, {_order('o_orderkey')} AS seq,
    'prod' AS rds, 'sales' AS db, 'orders' AS tb, cast(o_custkey AS VARCHAR) AS k1,
    cast(NULL AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3, o_orderstatus,
    cast(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority FROM orders"""
LINEITEM = f"""SELECT
    'I' AS "Op", l_shipdate AS moment, cast(l_shipdate AS VARCHAR) AS updated_at,
    cast(NULL AS VARCHAR) AS updated_by, {_order('l_partkey', 'l_suppkey')} AS seq,
    'prod' AS rds, 'sales' AS db, 'lineitem' AS tb, cast(l_orderkey AS VARCHAR) AS k1,
    cast(l_linenumber AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3,
    cast(l_quantity AS VARCHAR) AS l_quantity, cast(l_discount AS VARCHAR) AS l_discount,
    l_returnflag FROM lineitem"""

_AUDITED = {
    EVENTS: ("event_type", "value", "props"),
    EVENTS_WITH_GAPS: ("event_type", "value", "props"),
    EVENTS_X: ("value",),
    EVENTS_TWICE: ("event_type",),
    EVENTS_QUIET: ("value",),
    EVENT_TYPES: ("user_id", "value"),
    ORDERS: ("o_orderstatus", "o_totalprice", "o_orderpriority"),
    LINEITEM: ("l_quantity", "l_discount", "l_returnflag"),
}

_STRICT_LOG = f"""SELECT "Op", rds, db, tb, k1, k2, k3, updated_at, updated_by, {_DATED.format(moment='moment')},
    column_name, column_value, seq"""
_REFERENCE_LOG = _STRICT_LOG.replace(", seq", "")


def _lagged(versions: str, audited: tuple[str, ...]) -> str:
    previous = ", ".join(f"lag({c}) OVER w AS prev_{c}" for c in audited)
    return f"""SELECT *, {previous} FROM ({versions})
    WINDOW w AS (PARTITION BY rds, db, tb, k1, k2, k3 ORDER BY moment, seq)"""


def _cells(versions: str, audited: tuple[str, ...], semantics: str, where: str = "TRUE") -> str:
    """All changed cells with their previous value, and every field of the version."""
    lagged = _lagged(versions, audited)
    if semantics == "strict":
        row = " OR ".join(f"{c} IS DISTINCT FROM prev_{c}" for c in audited)
        cell = "column_value IS DISTINCT FROM previous_value"
    else:
        row = " OR ".join(f"({c} != prev_{c} OR (prev_{c} IS NULL AND {c} IS NOT NULL))" for c in audited)
        cell = "(column_value != previous_value OR previous_value IS NULL)"
    long = " UNION ALL ".join(
        f"SELECT *, '{c}' AS column_name, {c} AS column_value, prev_{c} AS previous_value FROM changed"
        for c in audited
    )
    return f"""(WITH changed AS (SELECT * FROM ({lagged}) WHERE {row}), long AS ({long})
    SELECT * FROM long WHERE {cell} AND {where})"""


def _log(versions: str, semantics: str = "strict", where: str = "TRUE") -> str:
    head = _STRICT_LOG if semantics == "strict" else _REFERENCE_LOG
    return f"{head} FROM {_cells(versions, _AUDITED[versions], semantics, where)}"


def _history(versions: str, cut: str = "2024-01-16") -> str:
    return f"SELECT * FROM ({versions}) WHERE moment < TIMESTAMP '{cut}'"


_AUDITED[_history(EVENTS)] = _AUDITED[EVENTS]
_AUDITED[_history(ORDERS, "1999-01-01")] = _AUDITED[ORDERS]

_AFTER_CUT = "moment >= TIMESTAMP '2024-01-16'"
_THREE = (EVENTS, EVENTS_X, EVENT_TYPES)


def _feed(op: str = """CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'I' ELSE 'U' END""", where: str = "TRUE") -> str:
    return f"""SELECT {op} AS "Op", event_id, user_id, event_type, value, props,
    cast(ts AS VARCHAR) AS updated_at FROM events WHERE {where}"""


def _latest(semantics: str) -> str:
    logs = " UNION ALL ".join(_log(v, semantics) for v in _THREE)
    newest = "updated_at DESC, seq DESC" if semantics == "strict" else "updated_at DESC"
    return f"""SELECT * FROM ({logs}) QUALIFY row_number() OVER (
    PARTITION BY rds, db, tb, k1, k2, k3, column_name ORDER BY {newest}) = 1"""


_FIXED = """"Op", rds, db, tb, k1, k2, k3, updated_at, updated_by, yearpart, monthpart, daypart"""


def _pivot(long: str, audited: tuple[str, ...]) -> str:
    wide = ", ".join(f"max(CASE WHEN column_name = '{c}' THEN column_value END) AS {c}" for c in audited)
    return f"SELECT {_FIXED}, {wide} FROM ({long}) GROUP BY {_FIXED}"


def _baseline_strict(versions: str, feed_keys: str = "") -> str:
    """Each column's own last value, beside the entity's last logged change."""
    audited = _AUDITED[versions]
    values = ", ".join(
        f"""arg_max_null(column_value, (updated_at, seq)) FILTER (WHERE column_name = '{c}') AS {c}"""
        for c in audited
    )
    last = ", ".join(
        f"arg_max_null({c}, (updated_at, seq)) AS {c}" for c in _FIXED.replace(" ", "").split(",") if c not in _KEYED
    )
    return f"""SELECT {', '.join(_KEYED)}, {last}, {values} FROM ({_log(versions)}) {feed_keys}
    GROUP BY {', '.join(_KEYED)}"""


_KEYED = ("rds", "db", "tb", "k1", "k2", "k3")


def _baseline_reference(versions: str) -> str:
    """Latest row per entity and column, pivoted by change; the entity's last pivoted row."""
    latest = f"""SELECT * FROM ({_log(versions, 'reference')}) QUALIFY row_number() OVER (
    PARTITION BY rds, db, tb, k1, k2, k3, column_name ORDER BY updated_at DESC) = 1"""
    return f"""SELECT * FROM ({_pivot(latest, _AUDITED[versions])}) QUALIFY row_number() OVER (
    PARTITION BY rds, db, tb, k1, k2, k3 ORDER BY updated_at DESC) = 1"""


def _incremental_reference(feed_where: str) -> str:
    """History's baseline and the feed in one line of versions; only the feed's changes count."""
    audited = _AUDITED[EVENTS]
    both = f"""SELECT "Op", rds, db, tb, k1, k2, k3, moment, updated_at, updated_by, seq,
        event_type, value, props, FALSE AS from_log FROM ({EVENTS}) WHERE {feed_where}
    UNION ALL
    SELECT "Op", rds, db, tb, k1, k2, k3, cast(updated_at AS TIMESTAMP), updated_at, updated_by, '',
        event_type, value, props, TRUE FROM ({_baseline_reference(_history(EVENTS))})"""
    return f"{_REFERENCE_LOG} FROM {_cells(both, audited, 'reference', 'NOT from_log')}"


_DELETED = "CASE WHEN event_type = 'error' THEN 'D' WHEN ts < TIMESTAMP '2024-01-16' THEN 'I' ELSE 'U' END"


def _with_deletes() -> str:
    """Deletes null every audited column; the first of several in a row logs each of them."""
    audited = _AUDITED[EVENTS]
    emptied = ", ".join(f"CASE WHEN \"Op\" = 'D' THEN NULL ELSE {c} END AS {c}" for c in audited)
    versions = f"SELECT * REPLACE ({emptied}) FROM ({_events(op=_DELETED)})"
    lagged = f"""SELECT *, "Op" = 'D' AND lag("Op") OVER w IS DISTINCT FROM 'D' AS deleted,
    {', '.join(f'lag({c}) OVER w AS prev_{c}' for c in audited)} FROM ({versions})
    WINDOW w AS (PARTITION BY k1 ORDER BY moment, seq)"""
    long = " UNION ALL ".join(
        f"SELECT *, '{c}' AS column_name, {c} AS column_value, prev_{c} AS previous_value FROM ({lagged})"
        for c in audited
    )
    return f"{_STRICT_LOG} FROM ({long}) WHERE deleted OR column_value IS DISTINCT FROM previous_value"


_UNDATED_TIME = "CASE WHEN event_type = 'error' THEN 'n/a' ELSE cast(ts AS VARCHAR) END"

_CONTROL = """SELECT 'server-' || cast(c_nationkey AS VARCHAR) AS rds_name,
    CASE WHEN c_nationkey < 12 THEN 'mysql' ELSE 'postgres' END AS rds_instance_type,
    lower(c_mktsegment) AS db_name, c_name AS tb_name,
    CASE WHEN c_acctbal >= 0 THEN 'id,line' ELSE '' END AS "primaryKey",
    'amount,state' AS audit_column,
    coalesce(c_acctbal > 5000 AND c_nationkey < 5, FALSE) AS "IsDelete" FROM customer"""

_WHOLE_LOG = _log(EVENTS)
_ALL_LOGS = " UNION ALL ".join(_log(versions) for versions in _THREE)


def _run_counts() -> str:
    """Initial: history. Incremental: the news. Last: one table purged, others read again.

    The third run reads the news once more and adds nothing; rows older than the entity's
    last version are counted as behind. The entry that is there twice loads the news in the first run already, the
    quiet one finds none, and the invalid one fails each time.
    """
    parts = []

    def row(run: int, versions: str, action: str, status: str, rows: str, changes: str, behind: str) -> None:
        numbers = ["cast(coalesce(({}), 0) AS BIGINT)".format(n) if n else "cast(NULL AS BIGINT)" for n in (rows, changes, behind)]
        parts.append(
            f"""SELECT cast({run} AS INTEGER) AS run, rds, db, tb, '{action}' AS action, '{status}' AS status,
            {numbers[0]} AS feed_rows, {numbers[1]} AS changes, {numbers[2]} AS behind_rows
            FROM (SELECT DISTINCT rds, db, tb FROM ({versions}))"""
        )

    for versions in (*_THREE, EVENTS_TWICE, EVENTS_QUIET):
        cells = _cells(versions, _AUDITED[versions], "strict")
        feed = f"SELECT count(*) FROM ({versions}) WHERE "
        logged = f"SELECT count(*) FROM {cells} WHERE "
        last_seen = f"SELECT k1, k2, max((moment, seq)) AS until FROM ({versions}) GROUP BY k1, k2"
        behind = f"""SELECT count(*) FROM ({versions}) v JOIN ({last_seen}) l
            ON v.k1 = l.k1 AND v.k2 IS NOT DISTINCT FROM l.k2
            WHERE v.{_AFTER_CUT} AND (v.moment, v.seq) < l.until"""
        first = (feed + "NOT " + _AFTER_CUT, logged + "NOT " + _AFTER_CUT, "SELECT 0")
        fresh, again = (feed + _AFTER_CUT, logged + _AFTER_CUT, "SELECT 0"), (feed + _AFTER_CUT, "SELECT 0", behind)
        row(1, versions, "initial", "done", *first)
        if versions == EVENTS_QUIET:
            for run in (2, 3):
                row(run, versions, "incremental", "empty", *["SELECT 0"] * 3)
        elif versions == EVENTS_TWICE:
            for run, counts in ((1, fresh), (2, again), (2, again), (3, again), (3, again)):
                row(run, versions, "incremental", "done", *counts)
        else:
            row(2, versions, "incremental", "done", *fresh)
            if versions == EVENTS:
                row(3, versions, "purge", "done", "", "", "")
            else:
                row(3, versions, "incremental", "done", *again)
    for run in (1, 2, 3):
        bad = "SELECT 'prod' AS rds, 'app' AS db, 'events_bad' AS tb"
        row(run, bad, "load", "failed", "", "", "")
    return " UNION ALL ".join(parts)


# The types of each user's first three events, all at one instant: each is logged when it is first seen.
_FIRST_TYPES = """SELECT DISTINCT 'U' AS "Op", 'prod' AS rds, 'app' AS db, 'first_types' AS tb,
    cast(user_id AS VARCHAR) AS k1, cast(NULL AS VARCHAR) AS k2, cast(NULL AS VARCHAR) AS k3,
    '2024-01-01 00:00:00' AS updated_at, cast(NULL AS VARCHAR) AS updated_by,
    cast(2024 AS INTEGER) AS yearpart, cast(1 AS INTEGER) AS monthpart, cast(1 AS INTEGER) AS daypart,
    'event_type' AS column_name, event_type AS column_value
    FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 3)"""

_EARLY = f"SELECT * FROM ({EVENTS_WITH_GAPS}) WHERE cast(right(seq, 19) AS BIGINT) % 3 <> 0"
_LATER = f"SELECT * FROM ({EVENTS_WITH_GAPS}) WHERE cast(right(seq, 19) AS BIGINT) % 3 = 0"


def _repaired() -> str:
    """The log of the early events and of later ones that are newer; and what late ones change.

    Each column's logged values, late values and value seen last, in order of time: late ones that differ from their
    predecessor are logged, and so is the value seen last where a late one now precedes it.
    """
    audited = _AUDITED[EVENTS]
    seen = f"SELECT * FROM ({_EARLY}) QUALIFY row_number() OVER (PARTITION BY k1 ORDER BY moment DESC, seq DESC) = 1"
    split = f"SELECT l.*, coalesce((l.moment, l.seq) < (s.moment, s.seq), FALSE) AS late FROM ({_LATER}) l LEFT JOIN ({seen}) s USING (k1)"
    in_order = f"({_EARLY}) UNION ALL (SELECT * EXCLUDE (late) FROM ({split}) WHERE NOT late)"
    late = f"SELECT * EXCLUDE (late) FROM ({split}) WHERE late"

    def long(versions: str, kind: int) -> str:
        return " UNION ALL ".join(
            f"SELECT * EXCLUDE ({', '.join(audited)}), {kind} AS kind, '{c}' AS column_name, {c} AS column_value FROM ({versions})"
            for c in audited
        )

    cells = _cells(_EARLY, audited, "strict")
    names = """"Op", moment, updated_at, updated_by, seq, rds, db, tb, k1, k2, k3, kind, column_name, column_value"""
    every = f"""SELECT {names} FROM (SELECT *, 0 AS kind FROM {cells}) UNION ALL SELECT {names} FROM ({long(late, 1)})
        UNION ALL SELECT {names} FROM ({long(seen, 2)} )"""
    placed = f"""SELECT *, lag(column_value) OVER (PARTITION BY k1, column_name ORDER BY moment, seq, kind) AS before,
        min(kind) OVER (PARTITION BY k1, column_name, moment, seq, column_value) AS first_kind FROM ({every})"""
    added = f"""{_STRICT_LOG} FROM ({placed}) WHERE kind > 0 AND first_kind > 0
        AND column_value IS DISTINCT FROM before AND k1 IN (SELECT k1 FROM ({late}))"""
    return f"{_STRICT_LOG} FROM {_cells(in_order, audited, 'strict')} UNION ALL {added}"


ORACLE_SQL: dict[str, str] = {
    "feed_full_load": _feed("'I'", "ts < TIMESTAMP '2024-01-16'"),
    "feed_incremental": _feed("'U'", "ts >= TIMESTAMP '2024-01-16'"),
    "feed_historical": _feed(),
    "feed_file_kind": """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'full'
        WHEN ts < TIMESTAMP '2024-01-20' THEN 'cdc' ELSE 'skip' END AS file_kind FROM events""",
    "feed_date_window": _feed(where="ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'"),
    "feed_date_window_today": _feed(where="ts >= TIMESTAMP '2024-01-21' AND ts < TIMESTAMP '2024-01-22'"),
    "control_table": _CONTROL,
    "control_purge_and_process": f"""SELECT rds_name, db_name, tb_name,
        CASE WHEN "IsDelete" THEN 'purge' ELSE 'process' END AS action FROM ({_CONTROL})""",
    "control_historical": f"""SELECT rds_name, db_name, tb_name,
        (db_name = 'furniture' AND tb_name IN ('Customer#000000000', 'Customer#000000005'))
        OR (db_name = 'machinery' AND tb_name = 'Customer#000000001') AS is_historical FROM ({_CONTROL})""",
    "conform_feed": f"""SELECT "Op", rds, db, tb, k1, k2, k3, updated_at, updated_by, FALSE AS from_log,
        {_DATED.format(moment='moment')}, seq AS change_order, event_type, value, props FROM ({EVENTS})""",
    "conform_missing_user": f"""SELECT "Op", k1, k2, updated_at, updated_by, l_quantity, l_discount, l_returnflag
        FROM ({LINEITEM})""",
    "keys_single": f"SELECT k1, k2, k3, updated_at, seq AS change_order FROM ({ORDERS})",
    "keys_composite": f"SELECT k1, k2, k3, updated_at FROM ({LINEITEM})",
    "keys_folded": """SELECT cast(l_orderkey AS VARCHAR) AS k1, cast(l_linenumber AS VARCHAR) AS k2,
        '["' || cast(l_partkey AS VARCHAR) || '","' || cast(l_suppkey AS VARCHAR) || '"]' AS k3 FROM lineitem""",
    "date_parts": f"""SELECT cast(user_id AS VARCHAR) AS k1, {_UNDATED_TIME} AS updated_at,
        cast(event_id % 7 AS VARCHAR) AS updated_by,
        {_DATED.format(moment=f"try_cast({_UNDATED_TIME} AS TIMESTAMP)")} FROM events""",
    "lag_previous": f"""SELECT "Op", k1, k2, k3, updated_at, updated_by, event_type, value, props,
        prev_event_type, prev_value, prev_props FROM ({_lagged(EVENTS_WITH_GAPS, _AUDITED[EVENTS])})""",
    "changed_rows": f"""SELECT "Op", k1, k2, k3, updated_at, updated_by, event_type, value, props
        FROM ({_lagged(EVENTS_WITH_GAPS, _AUDITED[EVENTS])})
        WHERE event_type IS DISTINCT FROM prev_event_type OR value IS DISTINCT FROM prev_value
        OR props IS DISTINCT FROM prev_props""",
    "changed_rows_reference": f"""SELECT "Op", k1, k2, k3, updated_at, updated_by, event_type, value, props
        FROM ({_lagged(EVENTS_WITH_GAPS, _AUDITED[EVENTS])})
        WHERE event_type != prev_event_type OR (prev_event_type IS NULL AND event_type IS NOT NULL)
        OR value != prev_value OR (prev_value IS NULL AND value IS NOT NULL)
        OR props != prev_props OR (prev_props IS NULL AND props IS NOT NULL)""",
    "change_log": _log(EVENTS_WITH_GAPS),
    "change_log_reference": _log(EVENTS_WITH_GAPS, "reference"),
    "change_log_with_previous": f"""{_STRICT_LOG}, previous_value FROM {_cells(ORDERS, _AUDITED[ORDERS], 'strict')}""",
    "change_log_composite_key": _log(LINEITEM),
    "change_log_with_deletes": _with_deletes(),
    "change_log_hot_keys": _log(EVENT_TYPES),
    "change_log_hot_keys_reference": _log(EVENT_TYPES, "reference"),
    "latest_values": _latest("strict"),
    "latest_values_reference": _latest("reference"),
    "pivot_log": _pivot(_log(ORDERS, "reference"), _AUDITED[ORDERS]),
    "baseline_strict": _baseline_strict(EVENTS),
    "baseline_reference": _baseline_reference(EVENTS),
    "baseline_of_feed_keys": _baseline_strict(
        _history(ORDERS, "1999-01-01"),
        "WHERE k1 IN (SELECT cast(o_custkey AS VARCHAR) FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')",
    ),
    "initial_change_log": _log(EVENTS),
    "incremental_change_log": _log(EVENTS, where=_AFTER_CUT),
    "incremental_change_log_reference": _incremental_reference(_AFTER_CUT),
    "incremental_change_log_ties": _log(ORDERS, where="moment >= TIMESTAMP '1999-01-01'"),
    "incremental_change_log_hot_keys": _log(EVENT_TYPES, where=_AFTER_CUT),
    "incremental_change_log_replayed": _log(EVENTS, where=_AFTER_CUT),
    "incremental_change_log_replayed_reference": _incremental_reference("TRUE"),
    "incremental_change_log_no_sequence": _FIRST_TYPES,
    "load_no_sequence": _FIRST_TYPES,
    "held_rows": f"""WITH newest AS (SELECT k1, max((moment, seq)) AS until
            FROM {_cells(_history(EVENTS), _AUDITED[EVENTS], 'strict')} GROUP BY k1)
        SELECT CASE WHEN event_type = 'error' THEN 'undated' ELSE 'behind' END AS reason,
            "Op", e.k1, k2, k3, CASE WHEN event_type = 'error' THEN 'n/a' ELSE updated_at END AS updated_at,
            updated_by, event_type, value, props
        FROM ({EVENTS}) e LEFT JOIN newest ON e.k1 = newest.k1
        WHERE event_type = 'error' OR (moment, seq) < until""",
    "log_append_roundtrip": _WHOLE_LOG,
    "log_scan_table": _WHOLE_LOG,
    "log_tables": f"SELECT DISTINCT rds, db, tb FROM ({_ALL_LOGS})",
    "log_tables_by_db": f"SELECT db, string_agg(DISTINCT tb, ',' ORDER BY tb) AS tables FROM ({_ALL_LOGS}) GROUP BY db",
    "log_compacted": _WHOLE_LOG,
    "table_state": f"""SELECT "Op", k1, k2, k3, updated_at, updated_by, seq AS change_order, event_type, value, props
        FROM ({EVENTS_WITH_GAPS}) QUALIFY row_number() OVER (PARTITION BY k1 ORDER BY moment DESC, seq DESC) = 1""",
    "load_from_state": _WHOLE_LOG,
    "late_rows_repaired": _repaired(),
    "purge_table": _log(EVENTS_X),
    "run_report": _run_counts(),
    "run_historical": _WHOLE_LOG,
    "stream_change_log": _WHOLE_LOG,
}
