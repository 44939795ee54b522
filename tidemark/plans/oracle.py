"""DuckDB oracle text for every driver query: independent SQL over the same Parquet tables.

Written from the contracts (survey sections 2.6-2.9), not from the Spark code:
window ROW_NUMBER dedup, NOT EXISTS anti-joins, FULL OUTER JOIN merges and a
closed-form (LAG/LEAD over batches) history for the SCD2 runs.
"""

from __future__ import annotations

from tidemark.plans import airline
from tidemark.plans import queries as Q
from tidemark.plans.models import tiebreak_columns
from tidemark.specs import FOREIGN_KEYS, MODELS, SNAPSHOTS
from tidemark.plans.views import (
    SQL_ARRIVAL, SQL_B_COUPON, SQL_B_JOURNAL, SQL_B_LEG, SQL_B_STATE, SQL_B_WAYBILL,
)

ACTIVE = "(_deleted = FALSE OR _deleted IS NULL)"
# White space of the email scan, and the two email patterns of the contract.
WS = r"[ \t\n\x0B\f\r]+"
EMAIL_TEST = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
EMAIL_MACRO = r"^[a-zA-Z0-9._%+''-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def latest(src: str, keys: str, order: str, where: str = "TRUE") -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
            f"FROM {src} WHERE {where}) WHERE rn = 1")


def audit(now: str, run: str) -> str:
    return (f"_synced AS _bronze_sync_timestamp, {ts(now)} AS _silver_load_timestamp, "
            f"'{run}' AS _run_id, _deleted AS _is_deleted")


# ---------------------------------------------------------------------------
# Refined batches
# ---------------------------------------------------------------------------
COUPON_ORDER = ("_synced DESC NULLS FIRST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
                "l_quantity DESC NULLS LAST, total_amount DESC NULLS LAST")
COUPON_CTE = f"""
b_coupon AS ({SQL_B_COUPON}),
coupon AS (
  SELECT ticket_number, coupon_number, flight_number, TRY_CAST(flight_date AS DATE) AS flight_date,
         total_amount, commission_amount,
         total_amount - COALESCE(commission_amount, 0) AS net_passenger_revenue,
         ticket_status, {audit(Q.COUPON_NOW, Q.RUN_1)}
  FROM ({latest('b_coupon', 'ticket_number, coupon_number', COUPON_ORDER,
                f"{ACTIVE} AND ticket_status = 'FLOWN' AND ticket_status NOT IN ('VOID', 'REFUNDED')")})
)"""


def leg_cte(extra_where: str = "TRUE") -> str:
    return f"""
b_leg AS ({SQL_B_LEG}),
leg AS (
  SELECT flight_id, CAST(flight_number AS VARCHAR) AS flight_number, TRY_CAST(flight_date AS DATE) AS flight_date,
         TRY_CAST(scheduled_dep AS TIMESTAMP) AS scheduled_dep, TRY_CAST(actual_dep AS TIMESTAMP) AS actual_dep,
         CAST(block_hours AS DECIMAL(10,2)) AS block_hours, flight_status, {audit(Q.LEG_NOW, Q.RUN_1)}
  FROM ({latest('b_leg', 'flight_id', '_synced DESC NULLS FIRST', f'{ACTIVE} AND {extra_where}')})
)"""


# state scenario: run 1 over what landed by T1, run 2 over everything past the mark / in the lookback
def state_cte(key: str, cols: str, order: str, cols_run1: str | None = None) -> str:
    return f"""
b AS ({SQL_B_STATE}),
t1 AS (
  SELECT {cols_run1 or cols}, {audit(Q.T1, Q.RUN_1)}
  FROM ({latest('b', key, order, f"{ACTIVE} AND {SQL_ARRIVAL} < {ts(Q.T1)}")})
),
wm AS (SELECT COALESCE(MAX(_bronze_sync_timestamp), TIMESTAMP '2000-01-01') AS wm FROM t1),
cand AS (
  SELECT * FROM b WHERE _synced > (SELECT wm FROM wm) OR _synced >= {ts(Q.T2)} - INTERVAL 3 DAY
),
u2 AS (
  SELECT {cols}, {audit(Q.T2, Q.RUN_2)}
  FROM ({latest('cand', key, order, ACTIVE)})
)"""


STATE_COLS = "user_id, event_id, event_type, value"
EVENT_COLS = "event_id, user_id, event_type, value"
STATE_ORDER = "_synced DESC NULLS FIRST, event_id DESC NULLS LAST"
EVENT_ORDER = "_synced DESC NULLS FIRST"


def merge_sql(key: str, cols: list[str], target_cols: list[str] | None = None, only_newer: bool = False) -> str:
    """FULL OUTER JOIN upsert of u2 into t1: update wins except the first load time."""
    target_cols = target_cols if target_cols is not None else cols
    take = "u.{k} IS NOT NULL".format(k=key)
    if only_newer:
        take += (" AND (t.{k} IS NULL OR COALESCE(u._bronze_sync_timestamp > t._bronze_sync_timestamp, "
                 "t._bronze_sync_timestamp IS NULL AND u._bronze_sync_timestamp IS NOT NULL, FALSE))").format(k=key)
    sel = [f"COALESCE(u.{key}, t.{key}) AS {key}"]
    for c in cols + ["_bronze_sync_timestamp", "_run_id", "_is_deleted"]:
        if c == key:
            continue
        if c in target_cols or c.startswith("_"):
            sel.append(f"CASE WHEN {take} THEN u.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN {take} THEN u.{c} END AS {c}")
    sel.append(f"CASE WHEN t.{key} IS NOT NULL THEN t._silver_load_timestamp "
               f"ELSE u._silver_load_timestamp END AS _silver_load_timestamp")
    return f"SELECT {', '.join(sel)} FROM t1 t FULL OUTER JOIN u2 u ON t.{key} = u.{key}"


# ---------------------------------------------------------------------------
# History (closed form over the three snapshot batches)
# ---------------------------------------------------------------------------
def _snap_batches() -> str:
    parts = []
    for i, cut in enumerate(Q.SNAP_CUTOFFS, start=1):
        seen = "TRUE" if cut == Q.SNAP_CUTOFFS[-1] else f"_synced < {ts(cut)}"  # the last run sees every row
        parts.append(f"SELECT {i} AS batch, {ts(cut)} AS now_ts, * FROM ({latest('b', 'user_id', STATE_ORDER, seen)})")
    return "\nUNION ALL\n".join(parts)


HISTORY_CTE = f"""
b AS ({SQL_B_STATE}),
s AS ({_snap_batches()}),
f AS (
  SELECT *, NOT _deleted AS live,
         LAG(NOT _deleted) OVER w AS prev_live,
         LAG(_synced) OVER w AS prev_synced,
         LAG(event_id) OVER w AS prev_event_id,
         LAG(event_type) OVER w AS prev_event_type,
         LAG(value) OVER w AS prev_value,
         LAG(_deleted) OVER w AS prev_deleted,
         COALESCE(BOOL_OR(NOT _deleted) OVER (PARTITION BY user_id ORDER BY batch
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS ever_live,
         MAX(CASE WHEN _deleted AND prev_live_raw THEN now_ts END) OVER (PARTITION BY user_id ORDER BY batch
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tomb_from
  FROM (SELECT *, LAG(NOT _deleted) OVER (PARTITION BY user_id ORDER BY batch) AS prev_live_raw FROM s)
  WINDOW w AS (PARTITION BY user_id ORDER BY batch)
),
v AS (
  SELECT user_id, event_id, event_type, value, _synced, _deleted, batch, _synced AS valid_from, FALSE AS is_deleted
  FROM f WHERE live AND (NOT ever_live OR (prev_live AND _synced > prev_synced))
  UNION ALL
  SELECT user_id, event_id, event_type, value, _synced, _deleted, batch, GREATEST(_synced, tomb_from), FALSE
  FROM f WHERE live AND ever_live AND NOT COALESCE(prev_live, FALSE)
  UNION ALL
  SELECT user_id, prev_event_id, prev_event_type, prev_value, prev_synced, prev_deleted, batch, now_ts, TRUE
  FROM f WHERE NOT live AND prev_live
),
h AS (
  SELECT user_id, event_id, event_type, value, _synced, _deleted,
         md5(CAST(user_id AS VARCHAR) || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') || '|'
             || CAST(is_deleted AS VARCHAR)) AS scd_id,
         valid_from,
         COALESCE(LEAD(valid_from) OVER (PARTITION BY user_id ORDER BY batch), TIMESTAMP '9999-12-31') AS valid_to,
         LEAD(valid_from) OVER (PARTITION BY user_id ORDER BY batch) IS NULL AS is_current,
         is_deleted
  FROM v
)"""

ORACLE: dict[str, str] = {}

ORACLE["q_active"] = f"WITH b AS ({SQL_B_COUPON}) SELECT * FROM b WHERE {ACTIVE}"

ORACLE["q_silver_ticket_coupon"] = f"WITH {COUPON_CTE} SELECT * FROM coupon"

ORACLE["q_silver_air_waybill"] = f"""
WITH b AS ({SQL_B_WAYBILL})
SELECT awb_number, flight_id, fjd_amount AS cargo_revenue, status, {audit(Q.LEG_NOW, Q.RUN_1)}
FROM ({latest('b', 'awb_number', '_synced DESC NULLS FIRST', f"{ACTIVE} AND status NOT IN ('CANCELLED')")})
"""

ORACLE["q_silver_gl_journal"] = f"""
WITH b AS ({SQL_B_JOURNAL})
SELECT journal_id, gl_account_code, base_amount, flight_id, approved_flag, {audit(Q.COUPON_NOW, Q.RUN_1)}
FROM ({latest('b', 'journal_id',
              '_synced DESC NULLS FIRST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, '
              'l_quantity DESC NULLS LAST, base_amount DESC NULLS LAST',
              f"{ACTIVE} AND approved_flag = 'Y'")})
"""

ORACLE["q_typed_leg"] = f"WITH {leg_cte()} SELECT * FROM leg"

ORACLE["q_dev_limit"] = (f"WITH {leg_cte(f'TRY_CAST(flight_date AS DATE) >= DATE {chr(39)}{Q.DEV_TODAY}{chr(39)} - INTERVAL 90 DAY')} "
                         "SELECT * FROM leg")

ORACLE["q_incremental_candidates"] = f"""
WITH {state_cte('user_id', STATE_COLS, STATE_ORDER)}
SELECT *, NOT (_synced > (SELECT wm FROM wm)) AS via_lookback FROM cand
"""

ORACLE["q_late_rows_lost"] = f"""
WITH {state_cte('user_id', STATE_COLS, STATE_ORDER)}
SELECT * FROM b
WHERE {SQL_ARRIVAL} >= {ts(Q.T1)}
  AND NOT (_synced > (SELECT wm FROM wm) OR _synced >= {ts(Q.T2)} - INTERVAL 3 DAY)
"""

ORACLE["q_merge_state"] = (f"WITH {state_cte('user_id', STATE_COLS, STATE_ORDER)} "
                           + merge_sql("user_id", STATE_COLS.split(", ")))
ORACLE["q_merge_events"] = (f"WITH {state_cte('event_id', EVENT_COLS, EVENT_ORDER)} "
                            + merge_sql("event_id", EVENT_COLS.split(", ")))
ORACLE["q_merge_events_shuffle"] = ORACLE["q_merge_events"]
ORACLE["q_merge_only_newer"] = (f"WITH {state_cte('user_id', STATE_COLS, STATE_ORDER)} "
                                + merge_sql("user_id", STATE_COLS.split(", "), only_newer=True))
ORACLE["q_schema_drift"] = (f"WITH {state_cte('event_id', EVENT_COLS, EVENT_ORDER, 'event_id, user_id, event_type')} "
                            + merge_sql("event_id", EVENT_COLS.split(", "), ["event_id", "user_id", "event_type"]))

ORACLE["q_scd2"] = f"WITH {HISTORY_CTE} SELECT * FROM h"

ORACLE["q_fk_orphans"] = """
SELECT doc_id, source FROM documents d
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

ORACLE["q_fk_composite"] = f"""
WITH {COUPON_CTE}, {leg_cte()}
SELECT ticket_number, coupon_number, flight_number, flight_date FROM coupon c
WHERE c.flight_number IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM leg p WHERE p.flight_number = c.flight_number AND p.flight_date = c.flight_date)
"""

ORACLE["q_fk_current"] = f"""
WITH {HISTORY_CTE}
SELECT event_id, user_id FROM b c
WHERE c.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM h p WHERE p.is_current AND p.user_id = c.user_id)
"""

ORACLE["q_fk_current_live"] = f"""
WITH {HISTORY_CTE}
SELECT event_id, user_id FROM b c
WHERE c.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM h p WHERE p.is_current AND NOT p.is_deleted AND p.user_id = c.user_id)
"""

ORACLE["q_unique"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
"""

ORACLE["q_unique_value"] = """
SELECT o_custkey, COUNT(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING COUNT(*) > 1
"""

ORACLE["q_not_null"] = f"WITH {leg_cte()} SELECT flight_id, flight_date FROM leg WHERE flight_date IS NULL"

ORACLE["q_positive"] = "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal > 0)"

ORACLE["q_positive_amount"] = "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal IS NOT NULL AND s_acctbal <= 0"

ORACLE["q_email"] = f"""
SELECT doc_id, token,
       COALESCE(regexp_full_match(token, '{EMAIL_MACRO}'), FALSE) AS macro_valid,
       regexp_full_match(token, '{EMAIL_TEST}') AS test_valid
FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '{WS}')) AS token FROM documents)
WHERE token LIKE '%@%'
"""

ORACLE["q_regex"] = """
SELECT 'customer' AS table_name, c_mktsegment AS value FROM customer
WHERE NOT COALESCE(regexp_full_match(c_mktsegment, '^[A-Z0-9]+$'), TRUE)
UNION ALL
SELECT 'part', p_brand FROM part WHERE NOT COALESCE(regexp_full_match(p_brand, '^[A-Z0-9]+$'), TRUE)
"""


def _type_check(table: str, col: str, expected: str) -> str:
    actual = (f"CASE typeof({col}) WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' "
              f"WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
              f"ELSE lower(typeof({col})) END")
    return (f"(SELECT * FROM (SELECT '{col}' AS col, '{expected}' AS expected, {actual} AS actual "
            f"FROM {table} LIMIT 1) WHERE upper(actual) <> upper(expected))")


ORACLE["q_type_check"] = "\nUNION ALL\n".join(_type_check(t, c, e) for t, c, e in Q.TYPE_EXPECTATIONS)


def _summary(name: str, severity: str, failures_sql: str) -> str:
    return (f"SELECT 'ticket_coupon' AS table_name, '{name}' AS check_name, '{severity}' AS severity, "
            f"CAST(({failures_sql}) AS BIGINT) AS failures, "
            f"CASE WHEN ({failures_sql}) = 0 THEN 'pass' ELSE '{severity}' END AS status")


ORACLE["q_checks_suite"] = f"""
WITH {COUPON_CTE}
{_summary('not_null_ticket_number', 'error', 'SELECT COUNT(*) FROM coupon WHERE ticket_number IS NULL')}
UNION ALL {_summary('expression_total_amount_>0', 'error', 'SELECT COUNT(*) FROM coupon WHERE NOT (total_amount > 0)')}
UNION ALL {_summary('regex_flight_number', 'warn',
                    "SELECT COUNT(*) FROM coupon WHERE NOT regexp_full_match(flight_number, '^[A-Z]+$')")}
UNION ALL {_summary('not_null_commission_amount', 'warn', 'SELECT COUNT(*) FROM coupon WHERE commission_amount IS NULL')}
UNION ALL {_summary('unique_combination_ticket_number_coupon_number', 'error',
                    'SELECT COUNT(*) FROM (SELECT 1 FROM coupon GROUP BY ticket_number, coupon_number HAVING COUNT(*) > 1)')}
UNION ALL {_summary('unique_ticket_number', 'warn',
                    'SELECT COUNT(*) FROM (SELECT 1 FROM coupon WHERE ticket_number IS NOT NULL '
                    'GROUP BY ticket_number HAVING COUNT(*) > 1)')}
"""


def _fresh(source: str, rel: str, col: str, warn: int, err: int) -> str:
    age = f"date_sub('second', MAX({col}), {ts(Q.FRESH_NOW)})"
    return (f"SELECT '{source}' AS source, MAX({col}) AS max_loaded_at, {age} AS age_seconds, "
            f"CASE WHEN MAX({col}) IS NULL THEN 'error' WHEN {age} > {err * 3600} THEN 'error' "
            f"WHEN {age} > {warn * 3600} THEN 'warn' ELSE 'pass' END AS status FROM {rel}")


ORACLE["q_freshness"] = " UNION ALL ".join([
    _fresh("events", "events", "ts", 1, 4),
    _fresh("coupons", "lineitem", "l_shipdate", 26, 30),
    _fresh("legs", "orders", "o_orderdate", 26, 30),
])

ORACLE["q_profile"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, "
    + (f"MAX({Q.PROFILE_SYNC[t]})" if t in Q.PROFILE_SYNC else "CAST(NULL AS TIMESTAMP)")
    + f" AS latest_sync FROM {t}"
    for t in sorted(Q.ALL_TABLES))

_DIFF_COLS = list(Q.DIFF_COMPARE)
ORACLE["q_snapshot_diff"] = f"""
WITH b AS ({SQL_B_COUPON}),
prev AS (SELECT * FROM ({latest('b', 'ticket_number, coupon_number', COUPON_ORDER,
                                 f'_synced < {ts(Q.DIFF_CUTOFF)}')}) WHERE {ACTIVE}),
curr AS (SELECT * FROM ({latest('b', 'ticket_number, coupon_number', COUPON_ORDER)}) WHERE {ACTIVE})
SELECT COALESCE(c.ticket_number, p.ticket_number) AS ticket_number,
       COALESCE(c.coupon_number, p.coupon_number) AS coupon_number,
       CASE WHEN p.ticket_number IS NULL THEN 'I' WHEN c.ticket_number IS NULL THEN 'D' ELSE 'U' END AS op,
       {', '.join(f'CASE WHEN c.ticket_number IS NOT NULL THEN c.{x} ELSE p.{x} END AS {x}' for x in _DIFF_COLS)}
FROM prev p FULL OUTER JOIN curr c ON p.ticket_number = c.ticket_number AND p.coupon_number = c.coupon_number
WHERE p.ticket_number IS NULL OR c.ticket_number IS NULL
   OR {' OR '.join(f'p.{x} IS DISTINCT FROM c.{x}' for x in _DIFF_COLS)}
"""

_FEED_ORDER = "_synced DESC NULLS LAST, event_id DESC NULLS LAST"
ORACLE["q_apply_changes"] = f"""
WITH b AS ({SQL_B_STATE}),
feed AS (SELECT user_id, event_id, event_type, value, _synced,
                CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op FROM b),
b0 AS (SELECT user_id, event_id, event_type, value, _synced, op = 'D' AS _deleted
       FROM ({latest('feed', 'user_id', _FEED_ORDER, f'_synced < {ts(Q.FEED_SPLIT)}')})),
f2 AS ({latest('feed', 'user_id', _FEED_ORDER, f'_synced >= {ts(Q.FEED_SPLIT)}')})
SELECT COALESCE(c.user_id, o.user_id) AS user_id,
       {', '.join(f"CASE WHEN c.user_id IS NOT NULL AND NOT (c.op = 'D' AND o.user_id IS NOT NULL) "
                  f"THEN c.{x} ELSE o.{x} END AS {x}" for x in ('event_id', 'event_type', 'value'))},
       CASE WHEN c.user_id IS NOT NULL THEN c._synced ELSE o._synced END AS _synced,
       CASE WHEN c.user_id IS NOT NULL THEN c.op = 'D' ELSE o._deleted END AS _deleted
FROM b0 o FULL OUTER JOIN f2 c ON o.user_id = c.user_id
"""

ORACLE["q_api_delta"] = f"""
WITH b AS ({SQL_B_STATE}),
b0 AS (SELECT event_id, user_id, event_type, value, _synced, FALSE AS _deleted
       FROM ({latest('b', 'user_id', _FEED_ORDER, f'{SQL_ARRIVAL} < {ts(Q.T1)}')})),
d AS ({latest('b', 'user_id', _FEED_ORDER, '_synced > (SELECT MAX(_synced) FROM b0)')})
SELECT COALESCE(c.user_id, o.user_id) AS user_id,
       {', '.join(f'CASE WHEN c.user_id IS NOT NULL THEN c.{x} ELSE o.{x} END AS {x}'
                  for x in ('event_id', 'event_type', 'value', '_synced'))},
       CASE WHEN c.user_id IS NOT NULL THEN FALSE ELSE o._deleted END AS _deleted
FROM b0 o FULL OUTER JOIN d c ON o.user_id = c.user_id
"""

ORACLE["q_mask_customer"] = "SELECT c_custkey, '***MASKED***' AS c_name, c_mktsegment FROM customer"

ORACLE["q_mask_orders"] = "SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS order_date FROM orders"

ORACLE["q_composite_key"] = """
SELECT o_orderkey,
       o_orderpriority || '-' || (CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END) || '-'
       || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS business_key
FROM orders
"""

ORACLE["q_stream_scd1"] = f"""
WITH b AS ({SQL_B_STATE})
SELECT user_id, event_id, event_type, value, _synced AS _bronze_sync_timestamp
FROM ({latest('b', 'user_id', STATE_ORDER, 'NOT _deleted')})
"""


# ---------------------------------------------------------------------------
# M1-M13 over the airline-shaped bronze, generated from the specs
# ---------------------------------------------------------------------------
def _col_sql(c) -> str:
    src = c.src or c.name
    if c.kind == "keep":
        return f"{src} AS {c.name}"
    if c.kind == "varchar":
        return f"CAST({src} AS VARCHAR) AS {c.name}"
    if c.kind == "date":
        return f"TRY_CAST({src} AS DATE) AS {c.name}"
    if c.kind == "ts":
        return f"TRY_CAST({src} AS TIMESTAMP) AS {c.name}"
    if c.kind == "dec":
        return f"CAST({src} AS DECIMAL(10,2)) AS {c.name}"
    if c.kind == "net":
        return f"{c.args[0]} - COALESCE({c.args[1]}, 0) AS {c.name}"
    raise ValueError(c.kind)


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def model_sql(name: str) -> str:
    spec = MODELS[name]
    keys = ", ".join(spec.keys)
    where = " AND ".join([ACTIVE]
                         + [f"{c} IN ({_in_list(v)})" for c, v in spec.include.items()]
                         + [f"{c} NOT IN ({_in_list(v)})" for c, v in spec.exclude.items()])
    order = "_synced DESC NULLS FIRST, " + ", ".join(f"{c} DESC NULLS LAST" for c in tiebreak_columns(spec))
    proj = ", ".join(_col_sql(c) for c in spec.columns)
    k0 = spec.keys[0]
    out_cols = [c.name for c in spec.columns if c.name not in spec.keys] + ["_bronze_sync_timestamp", "_run_id",
                                                                           "_is_deleted"]
    sel = [f"COALESCE(u.{k}, t.{k}) AS {k}" for k in spec.keys]
    sel += [f"CASE WHEN u.{k0} IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}" for c in out_cols]
    sel.append(f"CASE WHEN t.{k0} IS NOT NULL THEN t._silver_load_timestamp "
               f"ELSE u._silver_load_timestamp END AS _silver_load_timestamp")
    on = " AND ".join(f"t.{k} = u.{k}" for k in spec.keys)
    return f"""
WITH b AS ({airline.bronze_sql(spec.source)}),
t1 AS (SELECT {proj}, {audit(Q.MODEL_T1, Q.RUN_1)}
       FROM ({latest('b', keys, order, f'{where} AND _synced < {ts(Q.MODEL_T1)}')})),
wm AS (SELECT COALESCE(MAX(_bronze_sync_timestamp), TIMESTAMP '2000-01-01') AS wm FROM t1),
cand AS (SELECT * FROM b WHERE _synced > (SELECT wm FROM wm) OR _synced >= {ts(Q.MODEL_T2)} - INTERVAL 3 DAY),
u2 AS (SELECT {proj}, {audit(Q.MODEL_T2, Q.RUN_2)} FROM ({latest('cand', keys, order, where)}))
SELECT {', '.join(sel)} FROM t1 t FULL OUTER JOIN u2 u ON {on}
"""


def history_sql(name: str) -> str:
    spec = SNAPSHOTS[name]
    keys = ", ".join(spec.keys)
    rest = [c for c in spec.payload if c not in spec.keys] + ["_deleted"]
    order = "_synced DESC NULLS FIRST, " + ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    types = dict(airline.fields(spec.source))
    cols = [*spec.payload, "_synced", "_deleted"]
    on = " AND ".join(f"s1.{k} = s2.{k}" for k in spec.keys)

    def version(src: str, valid_from: str, valid_to: str, deleted: str) -> str:
        key = " || '-' || ".join(f"strftime({src}.{k}, '%Y-%m-%d')" if types[k] == "date" else f"CAST({src}.{k} AS VARCHAR)"
                                 for k in spec.keys)
        return (f"SELECT {', '.join(f'{src}.{c}' for c in cols)}, "
                f"md5({key} || '|' || strftime({valid_from}, '%Y-%m-%d %H:%M:%S.%f') || '|{deleted}') AS scd_id, "
                f"{valid_from} AS valid_from, {valid_to} AS valid_to, {valid_to} = {end} AS is_current, {deleted} AS is_deleted")

    end = "TIMESTAMP '9999-12-31'"
    t2 = ts(Q.MODEL_T2)
    closed = (f"CASE WHEN s2.{spec.keys[0]} IS NULL THEN {t2} WHEN s2._synced > s1._synced THEN s2._synced ELSE {end} END")
    return f"""
WITH b AS ({airline.bronze_sql(spec.source)}),
s1 AS (SELECT * FROM ({latest('b', keys, order, f'_synced < {ts(Q.MODEL_T1)}')}) WHERE {ACTIVE}),
s2 AS (SELECT * FROM ({latest('b', keys, order)}) WHERE {ACTIVE})
{version('s1', 's1._synced', closed, 'false')} FROM s1 LEFT JOIN s2 ON {on}
UNION ALL
{version('s2', 's2._synced', end, 'false')} FROM s2 LEFT JOIN s1 ON {on}
WHERE s1.{spec.keys[0]} IS NULL OR s2._synced > s1._synced
UNION ALL
{version('s1', t2, end, 'true')} FROM s1 LEFT JOIN s2 ON {on} WHERE s2.{spec.keys[0]} IS NULL
"""


for _n in MODELS:
    ORACLE[f"q_model_{_n}"] = model_sql(_n)
for _n in SNAPSHOTS:
    ORACLE[f"q_history_{_n}"] = history_sql(_n)

ORACLE["q_model_pnr_masked"] = f"""
WITH m AS ({model_sql("passenger_name_record")})
SELECT pnr_locator, pax_id, '***MASKED***' AS pax_first_name, '***MASKED***' AS pax_last_name,
       '***MASKED***' AS passport_number, make_date(year(date_of_birth), 1, 1) AS date_of_birth,
       _bronze_sync_timestamp, _silver_load_timestamp, _run_id, _is_deleted
FROM m
"""



def _check_failures(rel: str, c) -> str:
    col = c.columns[0]
    if c.kind == "not_null":
        return f"SELECT COUNT(*) FROM {rel} WHERE {col} IS NULL"
    if c.kind == "unique":
        return f"SELECT COUNT(*) FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)"
    if c.kind == "unique_combination":
        cols = ", ".join(c.columns)
        return f"SELECT COUNT(*) FROM (SELECT 1 FROM {rel} GROUP BY {cols} HAVING COUNT(*) > 1)"
    if c.kind == "expression":
        return f"SELECT COUNT(*) FROM {rel} WHERE NOT ({col} {c.arg})"
    if c.kind == "regex":
        return f"SELECT COUNT(*) FROM {rel} WHERE NOT regexp_full_match({col}, '{c.arg}')"
    raise ValueError(c.kind)


def _summary_row(table: str, name: str, severity: str, failures: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity, "
            f"CAST(({failures}) AS BIGINT) AS failures, "
            f"CASE WHEN ({failures}) = 0 THEN 'pass' ELSE '{severity}' END AS status")


def _outputs_cte(names) -> str:
    parts = [f"m_{n} AS ({model_sql(n)})" for n in MODELS if n in names]
    parts += [f"m_{n} AS ({history_sql(n)})" for n in SNAPSHOTS if n in names]
    return ",\n".join(parts)


_ALL_OUTPUTS = list(MODELS) + list(SNAPSHOTS)
ORACLE["q_model_checks"] = f"WITH {_outputs_cte(_ALL_OUTPUTS)}\n" + "\nUNION ALL\n".join(
    _summary_row(n, c.name, c.severity, _check_failures(f"m_{n}", c))
    for n in _ALL_OUTPUTS for c in (MODELS[n].checks if n in MODELS else SNAPSHOTS[n].checks))


def _fk_failures(fk) -> str:
    match = " AND ".join(f"p.{pc} = c.{cc}" for cc, pc in zip(fk.child_cols, fk.parent_cols))
    if fk.parent_current_only:
        match = "p.is_current AND " + match
    return (f"SELECT COUNT(*) FROM m_{fk.child} c WHERE c.{fk.child_cols[0]} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM m_{fk.parent} p WHERE {match})")


_FK_TABLES = {fk.child for fk in FOREIGN_KEYS} | {fk.parent for fk in FOREIGN_KEYS}
ORACLE["q_model_fk_suite"] = f"WITH {_outputs_cte(_FK_TABLES)}\n" + "\nUNION ALL\n".join(
    _summary_row(fk.child, fk.name, fk.severity, _fk_failures(fk)) for fk in FOREIGN_KEYS)

ORACLE["q_apply_changes_shuffle"] = ORACLE["q_apply_changes"]
ORACLE["q_incremental_landed"] = ORACLE["q_incremental_candidates"]

# --- K8, S1, S10, bronze ingest, streamed history ------------------------------------------------------
ORACLE["q_full_refresh_guard"] = f"""
WITH {state_cte('user_id', STATE_COLS, STATE_ORDER)},
refused AS ({merge_sql("user_id", STATE_COLS.split(", "))}),
rebuilt AS (SELECT {STATE_COLS}, {audit(Q.T2, Q.RUN_2)} FROM ({latest('b', 'user_id', STATE_ORDER, ACTIVE)}))
SELECT *, FALSE AS refresh_allowed FROM refused UNION ALL BY NAME SELECT *, TRUE AS refresh_allowed FROM rebuilt
"""

ORACLE["q_scan_declared"] = (f"SELECT flight_id, flight_status, block_hours, _synced FROM ({airline.bronze_sql('flight_leg')})")

_D1, _D2 = map(ts, Q.DRIFT_CUTS)
ORACLE["q_schema_admission"] = f"""
SELECT event_id, user_id, event_type,
       CASE WHEN ts >= {_D2} THEN value WHEN ts >= {_D1} THEN CAST(CAST(value AS FLOAT) AS DOUBLE) END AS value,
       'user_id:bigint,value:double' AS kinds, 'events,new_table,events' AS admitted
FROM events
"""

_LIVE = f"_synced < {ts(Q.FEED_SPLIT)}"
ORACLE["q_ingest_bronze"] = f"""
WITH change_feed AS ({ORACLE["q_apply_changes"]}),
api_delta AS ({ORACLE["q_api_delta"]}),
b AS ({SQL_B_STATE}),
file_drop AS (SELECT user_id, event_id, event_type, value, _synced, FALSE AS _deleted FROM ({latest('b', 'user_id', _FEED_ORDER)})),
c1 AS (SELECT * FROM ({latest('b', 'user_id', STATE_ORDER, _LIVE)}) WHERE {ACTIVE}),
c2 AS (SELECT * FROM ({latest('b', 'user_id', STATE_ORDER)}) WHERE {ACTIVE}),
snapshot_diff AS (
  SELECT COALESCE(c2.user_id, c1.user_id) AS user_id,
         {', '.join(f'CASE WHEN c2.user_id IS NULL THEN c1.{x} ELSE c2.{x} END AS {x}' for x in ('event_id', 'event_type', 'value'))},
         CASE WHEN c1.user_id IS NOT NULL AND c2.user_id IS NOT NULL AND c1.event_id IS NOT DISTINCT FROM c2.event_id
                   AND c1.event_type IS NOT DISTINCT FROM c2.event_type AND c1.value IS NOT DISTINCT FROM c2.value
              THEN {ts(Q.FEED_SPLIT)} ELSE {ts(Q.T2)} END AS _synced,
         c2.user_id IS NULL AS _deleted
  FROM c1 FULL OUTER JOIN c2 ON c1.user_id = c2.user_id
)
{' UNION ALL '.join(f"SELECT '{m}' AS method, user_id, event_id, event_type, value, _synced, _deleted FROM {m}"
                    for m in ('change_feed', 'api_delta', 'file_drop', 'snapshot_diff'))}
"""

ORACLE["q_stream_scd2"] = f"""
WITH b AS ({SQL_B_STATE}),
one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, _synced ORDER BY event_id DESC) AS rn FROM b)
        WHERE rn = 1),
told AS (SELECT *, _deleted AND COALESCE(LAG(_deleted) OVER w, TRUE) AS void,
                MAX(CASE WHEN NOT _deleted THEN _synced END) OVER (PARTITION BY user_id ORDER BY _synced) AS live_at
         FROM one WINDOW w AS (PARTITION BY user_id ORDER BY _synced))
SELECT t.user_id, l.event_id, l.event_type, l.value, l._synced, l._deleted,
       md5(CAST(t.user_id AS VARCHAR) || '|' || strftime(t._synced, '%Y-%m-%d %H:%M:%S.%f') || '|'
           || CAST(t._deleted AS VARCHAR)) AS scd_id,
       t._synced AS valid_from,
       COALESCE(LEAD(t._synced) OVER v, TIMESTAMP '9999-12-31') AS valid_to,
       LEAD(t._synced) OVER v IS NULL AS is_current, t._deleted AS is_deleted
FROM told t JOIN one l ON l.user_id = t.user_id AND l._synced = t.live_at
WHERE NOT t.void WINDOW v AS (PARTITION BY t.user_id ORDER BY t._synced)
"""

ORACLE["q_unique_incremental"] = ORACLE["q_unique"]
ORACLE["q_freshness_landed"] = _fresh("events", "events", "ts", 1, 4)
