"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, as plain SQL over the driver's
views: windows use ``lag`` over ``(card_num, day)``, gaps are exact
microsecond differences (``epoch_us``), whole units use ``trunc`` (DuckDB's
``CAST(x AS INT)`` rounds).
"""

from __future__ import annotations

FIXTURE = """
WITH
txn AS (
  SELECT event_id AS trans_id, ts AS trans_date, value AS amt, user_id AS card_num,
         event_type AS oper_type,
         CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
         CASE WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'REJECT' END AS strict_result,
         event_id % 10 AS terminal
  FROM events),
busy AS (
  SELECT trans_id, date_trunc('day', trans_date) + to_seconds(
           (epoch_us(trans_date) - epoch_us(date_trunc('day', trans_date))) // 1000000 // 24) AS trans_date,
         amt, card_num % 20 AS card_num, oper_type, strict_result AS oper_result, trans_id % 300 AS terminal
  FROM txn),
clients AS (
  SELECT c_custkey AS client_id, c_name AS last_name, c_mktsegment AS first_name,
         CASE WHEN c_custkey % 50 = 49 THEN NULL ELSE 'N' || c_nationkey END AS patronymic,
         'P' || c_custkey AS passport_num,
         CASE WHEN c_custkey % 5 = 0 THEN NULL
              ELSE DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) END AS passport_valid_to,
         'T' || c_custkey AS phone
  FROM customer),
accounts AS (
  SELECT c_custkey + 1000000 AS account_num,
         DATE '2024-01-01' + CAST((c_custkey * 7) % 90 AS INTEGER) AS valid_to,
         c_custkey AS client
  FROM customer),
cards AS (SELECT c_custkey AS card_num, c_custkey + 1000000 AS account_num FROM customer),
blacklist AS (SELECT 'P' || c_custkey AS passport_num FROM customer WHERE c_acctbal < 0),
blacklist_with_null AS (
  SELECT CASE WHEN c_custkey % 50 = 49 THEN NULL ELSE 'P' || c_custkey END AS passport_num
  FROM customer WHERE c_acctbal < 0),
blacklist_feed AS (
  SELECT 'P' || c_custkey AS passport_num, DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS entry_dt
  FROM customer WHERE c_acctbal < 500),
owners AS (
  SELECT k.card_num, k.account_num, a.valid_to AS account_valid_to, c.client_id, c.passport_num,
         c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.phone,
         c.passport_valid_to
  FROM cards k JOIN accounts a ON k.account_num = a.account_num JOIN clients c ON a.client = c.client_id),
hist AS (
  SELECT s_suppkey AS terminal_id, CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n_name AS terminal_city, s_name AS terminal_address,
         TIMESTAMP '2023-01-01 00:00:00' AS effective_from,
         CASE WHEN s_suppkey % 3 = 0 THEN TIMESTAMP '2024-01-14 23:59:59'
              ELSE TIMESTAMP '2999-12-31 23:59:59' END AS effective_to,
         false AS deleted_flg
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END, n_name, s_name,
         TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2999-12-31 23:59:59', false
  FROM supplier JOIN nation ON (s_nationkey + 1) % 25 = n_nationkey WHERE s_suppkey % 3 = 0),
old_hist AS (
  SELECT s_suppkey AS terminal_id, CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n_name AS terminal_city, s_name AS terminal_address,
         TIMESTAMP '2023-01-01 00:00:00' AS effective_from, TIMESTAMP '2999-12-31 23:59:59' AS effective_to,
         false AS deleted_flg
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0),
snap AS (
  SELECT s_suppkey AS terminal_id, CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n_name AS terminal_city, s_name AS terminal_address
  FROM supplier JOIN nation
    ON CASE WHEN s_suppkey % 3 = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END = n_nationkey
  WHERE s_suppkey % 5 <> 0),
active AS (
  SELECT * FROM old_hist
  WHERE TIMESTAMP '2024-02-01 00:00:00' BETWEEN effective_from AND effective_to AND NOT deleted_flg),
snap_new AS (SELECT * FROM snap WHERE terminal_id NOT IN (SELECT terminal_id FROM active)),
snap_deleted AS (SELECT * FROM active WHERE terminal_id NOT IN (SELECT terminal_id FROM snap)),
snap_changed AS (
  SELECT s.* FROM snap s JOIN active a ON s.terminal_id = a.terminal_id
  WHERE s.terminal_type <> a.terminal_type OR s.terminal_city <> a.terminal_city
     OR s.terminal_address <> a.terminal_address)
"""

REPORT = "event_dt, passport, fio, phone, event_type"

_R1 = """
SELECT t.trans_date AS event_dt, o.passport_num AS passport, o.fio, o.phone, 'overdue_passport' AS event_type
FROM txn t JOIN owners o ON t.card_num = o.card_num
WHERE t.oper_result = 'SUCCESS' AND o.passport_valid_to IS NOT NULL
  AND CAST(t.trans_date AS DATE) > o.passport_valid_to {day}
UNION ALL
SELECT t.trans_date, o.passport_num, o.fio, o.phone, 'blocked_passport'
FROM txn t JOIN owners o ON t.card_num = o.card_num
WHERE t.oper_result = 'SUCCESS' AND o.passport_num IN (SELECT passport_num FROM blacklist) {day}
"""

_R2 = """
SELECT t.trans_date AS event_dt, o.passport_num AS passport, o.fio, o.phone, 'overdue_account' AS event_type
FROM txn t JOIN owners o ON t.card_num = o.card_num
WHERE t.oper_result = 'SUCCESS' AND CAST(t.trans_date AS DATE) > o.account_valid_to {day}
"""

_R3 = """
SELECT s.trans_date AS event_dt, o.passport_num AS passport, o.fio, o.phone, 'diff_city' AS event_type
FROM (
  SELECT t.card_num, t.trans_date, h.terminal_city,
         lag(t.trans_date) OVER w AS prev_ts, lag(h.terminal_city) OVER w AS prev_city
  FROM txn t JOIN hist h ON t.terminal = h.terminal_id {asof}
  WHERE t.oper_result = 'SUCCESS' {day}
  WINDOW w AS (PARTITION BY t.card_num, CAST(t.trans_date AS DATE)
               ORDER BY t.trans_date, h.effective_from, h.terminal_city, t.trans_id)) s
JOIN owners o ON s.card_num = o.card_num
WHERE s.terminal_city <> s.prev_city
  AND epoch_us(s.trans_date) - epoch_us(s.prev_ts) < CAST({gap_min} AS BIGINT) * 60 * 1000000
"""

_ASOF = "AND t.trans_date BETWEEN h.effective_from AND h.effective_to AND NOT h.deleted_flg"


def _r4(k: int, gap_min: int, result: str = "strict_result") -> str:
    lags = ",\n         ".join(
        f"lag({result}, {i}) OVER w AS r{i}, lag(amt, {i}) OVER w AS a{i}" for i in range(1, k + 1))
    conds = [f"s.{result} = 'SUCCESS'"] + [f"s.r{i} = 'REJECT'" for i in range(1, k + 1)]
    chain = ["s.amt"] + [f"s.a{i}" for i in range(1, k + 1)]
    conds += [f"trunc({x}) < trunc({y})" for x, y in zip(chain, chain[1:])]
    conds.append(f"epoch_us(s.trans_date) - epoch_us(s.t{k}) < CAST({gap_min} AS BIGINT) * 60 * 1000000")
    where = "\n  AND ".join(conds)
    return f"""
SELECT s.trans_date AS event_dt, o.passport_num AS passport, o.fio, o.phone, 'sum_guessing' AS event_type
FROM (
  SELECT t.*, {lags},
         lag(trans_date, {k}) OVER w AS t{k}
  FROM txn t
  WINDOW w AS (PARTITION BY card_num, CAST(trans_date AS DATE) ORDER BY trans_date, trans_id)) s
JOIN owners o ON s.card_num = o.card_num
WHERE {where}
"""


_DAY = "AND CAST(t.trans_date AS DATE) = DATE '2024-01-20'"

_HIST_COLS = "terminal_id, terminal_type, terminal_city, terminal_address, effective_from, effective_to, deleted_flg"

_CLOSE_AT = "TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 1 SECOND"

_CLOSING = "(SELECT terminal_id FROM snap_deleted UNION SELECT terminal_id FROM snap_changed)"

_OPEN = """
SELECT terminal_id, terminal_type, terminal_city, terminal_address,
       TIMESTAMP '2024-02-01 00:00:00' AS effective_from, TIMESTAMP '2999-12-31 23:59:59' AS effective_to,
       {flag} AS deleted_flg
FROM {src}
"""

_CLOSED = f"""
SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from,
       CASE WHEN effective_to = TIMESTAMP '2999-12-31 23:59:59' AND terminal_id IN {_CLOSING}
            THEN {_CLOSE_AT} ELSE effective_to END AS effective_to,
       deleted_flg
FROM old_hist
"""

def _busy(sql: str) -> str:
    return sql.replace("FROM txn t", "FROM busy t")


def _one_second(sql: str) -> str:
    return sql.replace("FROM txn t", "FROM (SELECT * REPLACE (date_trunc('day', trans_date) AS trans_date) FROM busy) t")


# The series of snapshots: per key and day presence and values; islands and
# changes from neighbouring days (no value of the fixture is NULL).
_SERIES_RULES = ["(s_suppkey + 0) % 3 <> 0", "(s_suppkey + 1) % 4 <> 0", "s_suppkey % 2 = 0", "(s_suppkey + 3) % 6 <> 0"]
_SERIES_TIMES = ["2024-02-01", "2024-02-02", "2024-02-03", "2024-02-05"]
_SERIES_DAYS = " UNION ALL ".join(
    f"""SELECT {i + 1} AS no, TIMESTAMP '{t} 00:00:00' AS as_of, s_suppkey AS terminal_id, n_name AS terminal_city, s_name AS terminal_address
    FROM supplier JOIN nation ON CASE WHEN (s_suppkey + {i}) % 3 = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END = n_nationkey
    WHERE {rule}""" for i, (rule, t) in enumerate(zip(_SERIES_RULES, _SERIES_TIMES)))
_SERIES_STARTS = " UNION ALL ".join(f"SELECT {i + 1}, TIMESTAMP '{t} 00:00:00'" for i, t in enumerate(_SERIES_TIMES))


def _series(clean: bool) -> str:
    closing = "true" if clean else "kind <> 'new'"
    return f""",
days(no, as_of) AS ({_SERIES_STARTS}),
seen AS ({_SERIES_DAYS} UNION ALL
  SELECT 0, NULL, terminal_id, terminal_city, terminal_address FROM old_hist),
grid AS (
  SELECT k.terminal_id, d.no, d.as_of, s.terminal_city AS city, s.terminal_address AS address, s.terminal_id IS NOT NULL AS here
  FROM (SELECT DISTINCT terminal_id FROM seen) k CROSS JOIN (SELECT * FROM days UNION ALL SELECT 0, NULL) d
  LEFT JOIN seen s ON s.terminal_id = k.terminal_id AND s.no = d.no),
steps AS (
  SELECT *, lag(here) OVER w AS was, lag(city) OVER w AS old_city, lag(address) OVER w AS old_address
  FROM grid WINDOW w AS (PARTITION BY terminal_id ORDER BY no)),
events AS (
  SELECT terminal_id, no, as_of,
         CASE WHEN here AND NOT was THEN 'new' WHEN was AND NOT here THEN 'deleted' ELSE 'changed' END AS kind,
         CASE WHEN here THEN city ELSE old_city END AS city, CASE WHEN here THEN address ELSE old_address END AS address
  FROM steps WHERE no > 0 AND (here <> was OR (here AND (city <> old_city OR address <> old_address)))),
ends AS (SELECT terminal_id, no, as_of FROM events WHERE {closing})
SELECT terminal_id, CASE WHEN terminal_id % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type, city AS terminal_city,
       address AS terminal_address, as_of AS effective_from,
       coalesce((SELECT min(x.as_of) FROM ends x WHERE x.terminal_id = e.terminal_id AND x.no > e.no) - INTERVAL 1 SECOND,
                TIMESTAMP '2999-12-31 23:59:59') AS effective_to, kind = 'deleted' AS deleted_flg
FROM events e
UNION ALL
SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from,
       coalesce((SELECT min(x.as_of) FROM ends x WHERE x.terminal_id = o.terminal_id) - INTERVAL 1 SECOND, effective_to), deleted_flg
FROM old_hist o"""


_CENTS = "CAST(floor(amt * 100) AS BIGINT)"

SQL: dict[str, str] = {
    "city_switch_as_of_day": _R3.format(asof=_ASOF, day=_DAY, gap_min=60),
    "city_switch_split": _busy(_R3.format(asof="", day="", gap_min=60)),
    "declining_attempts_k3_gap": _busy(_r4(3, 20, "oper_result")),
    "declining_attempts_split": _busy(_r4(2, 20, "oper_result")),
    "fraud_report_busy": _busy("\nUNION ALL\n".join([
        _R1.format(day=""), _R2.format(day=""), _R3.format(asof=_ASOF, day="", gap_min=60),
        _r4(3, 20, "oper_result")])),
    "city_switch_carried": _busy(_R3.format(asof=_ASOF, day="", gap_min=60)),
    "declining_attempts_one_second": _one_second(_r4(3, 20, "oper_result")),
    "scd2_apply_series": _series(clean=False),
    "scd2_apply_series_clean": _series(clean=True),
    "parse_feed_lines": f"""SELECT CAST(trans_id AS VARCHAR) AS transaction_id,
        CASE WHEN trans_id % 89 <> 0 THEN date_trunc('second', trans_date) END AS transaction_date,
        CASE WHEN trans_id % 97 <> 0 THEN {_CENTS} END AS amount_cents, CAST(card_num AS VARCHAR) AS card_num, oper_type,
        oper_result, CAST(terminal AS VARCHAR) AS terminal, trans_id % 89 = 0 AS bad_time, trans_id % 97 = 0 AS bad_amount
        FROM txn""",
    "unique_keys_guarded": """SELECT trans_id, trans_date, card_num, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY trans_id ORDER BY trans_date, card_num, event_id) AS n
              FROM (SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 3000 END AS trans_id, ts AS trans_date,
                           user_id AS card_num, event_id FROM events))
        WHERE trans_id IS NULL OR (n = 1 AND trans_id NOT IN (SELECT event_id % 3000 FROM events WHERE event_id % 3000 < 100))""",
    "orphan_report": """SELECT 'cards.account_num -> accounts' AS relation, CAST(card_num AS VARCHAR) AS row_key,
        CAST(account_num AS VARCHAR) AS reference FROM cards WHERE card_num % 7 <> 0
          AND account_num NOT IN (SELECT account_num FROM accounts WHERE account_num % 11 <> 0)
        UNION ALL SELECT 'accounts.client -> clients', CAST(account_num AS VARCHAR), CAST(client AS VARCHAR) FROM accounts
        WHERE account_num % 11 <> 0 AND client NOT IN (SELECT client_id FROM clients WHERE client_id % 13 <> 0)
        UNION ALL SELECT 'transactions.card_num -> cards', CAST(trans_id AS VARCHAR), CAST(card_num AS VARCHAR) FROM busy
        WHERE card_num NOT IN (SELECT card_num FROM cards WHERE card_num % 7 <> 0)
        UNION ALL SELECT 'transactions.terminal -> terminals', CAST(trans_id AS VARCHAR), CAST(terminal AS VARCHAR) FROM busy
        WHERE terminal NOT IN (SELECT terminal_id FROM hist)""",
    "day_slice": f"SELECT trans_id, trans_date, amt, card_num, oper_type, oper_result, terminal FROM txn t WHERE true {_DAY}",
    "ownership_chain": """SELECT t.trans_id, t.card_num, o.account_num, o.client_id,
        o.passport_num, o.fio, o.phone FROM txn t JOIN owners o ON t.card_num = o.card_num""",
    "full_name": "SELECT client_id, last_name || ' ' || first_name || ' ' || patronymic AS fio FROM clients",
    "expired_documents": """SELECT client_id, passport_num, last_name || ' ' || first_name || ' ' || patronymic AS fio,
        phone, 'overdue_passport' AS event_type FROM clients
        WHERE passport_valid_to IS NOT NULL AND DATE '2024-01-20' > passport_valid_to""",
    "listed_documents": """SELECT client_id, passport_num, last_name || ' ' || first_name || ' ' || patronymic AS fio,
        phone, 'blocked_passport' AS event_type FROM clients
        WHERE passport_num IN (SELECT passport_num FROM blacklist)""",
    "bad_document_union": """SELECT client_id, passport_num, last_name || ' ' || first_name || ' ' || patronymic AS fio,
        phone, 'overdue_passport' AS event_type FROM clients
        WHERE passport_valid_to IS NOT NULL AND DATE '2024-01-20' > passport_valid_to
        UNION
        SELECT client_id, passport_num, last_name || ' ' || first_name || ' ' || patronymic AS fio,
        phone, 'blocked_passport' AS event_type FROM clients
        WHERE passport_num IN (SELECT passport_num FROM blacklist)""",
    "bad_document_ops": _R1.format(day=""),
    "bad_document_ops_day": _R1.format(day=_DAY),
    "lapsed_contract_ops": _R2.format(day=""),
    "lapsed_contract_ops_day": _R2.format(day=_DAY),
    "city_switch_all_versions": _R3.format(asof="", day="", gap_min=60),
    "city_switch_as_of": _R3.format(asof=_ASOF, day="", gap_min=60),
    "city_switch_all_versions_day": _R3.format(asof="", day=_DAY, gap_min=60),
    "declining_attempts_k2": _r4(2, 24 * 60),
    "declining_attempts_k3": _r4(3, 24 * 60),
    "fraud_report": "\nUNION ALL\n".join([
        _R1.format(day=""), _R2.format(day=""), _R3.format(asof=_ASOF, day="", gap_min=60),
        _r4(3, 20, "oper_result")]),
    "fraud_report_day": "\nUNION ALL\n".join([
        _R1.format(day=_DAY), _R2.format(day=_DAY), _R3.format(asof=_ASOF, day=_DAY, gap_min=60),
        _r4(3, 20, "oper_result").replace("FROM txn t\n", f"FROM txn t WHERE true {_DAY}\n")]),
    "rename_transactions": "SELECT trans_id, trans_date, amt, card_num, oper_type, oper_result, terminal FROM txn",
    "insert_if_absent": """SELECT passport_num FROM blacklist_feed
        WHERE passport_num NOT IN (SELECT passport_num FROM blacklist)""",
    "insert_if_absent_null_list": """SELECT passport_num FROM blacklist_feed
        WHERE passport_num NOT IN (SELECT passport_num FROM blacklist_with_null)""",
    "insert_if_absent_ignore_nulls": """SELECT f.passport_num FROM blacklist_feed f
        WHERE NOT EXISTS (SELECT 1 FROM blacklist_with_null b WHERE b.passport_num = f.passport_num)""",
    "active_versions": f"""SELECT {_HIST_COLS} FROM hist
        WHERE TIMESTAMP '2024-01-20 12:00:00' BETWEEN effective_from AND effective_to AND NOT deleted_flg""",
    "snapshot_new": "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM snap_new",
    "snapshot_deleted": f"SELECT {_HIST_COLS} FROM snap_deleted",
    "snapshot_changed": "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM snap_changed",
    "open_versions": _OPEN.format(flag="false", src="snap_new") + " UNION ALL " + _OPEN.format(
        flag="false", src="snap_changed"),
    "close_versions": f"""SELECT terminal_id, terminal_type, terminal_city, terminal_address, effective_from,
        {_CLOSE_AT} AS effective_to, deleted_flg FROM old_hist
        WHERE effective_to = TIMESTAMP '2999-12-31 23:59:59' AND terminal_id IN {_CLOSING}""",
    "tombstones": _OPEN.format(flag="true", src="snap_deleted"),
    "scd2_apply": _CLOSED + " UNION ALL " + _OPEN.format(flag="false", src="snap_new")
    + " UNION ALL " + _OPEN.format(flag="true", src="snap_deleted")
    + " UNION ALL " + _OPEN.format(flag="false", src="snap_changed"),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "orphans": """SELECT t.trans_id, t.card_num FROM txn t
        WHERE t.card_num IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM cards k WHERE k.card_num % 7 <> 0 AND k.card_num = t.card_num)""",
}


# Queries that go through files (the same rows by plain SQL).
_WHOLE = "trans_id % 83 <> 0 AND trans_id % 79 <> 0"
SQL.update({
    "feed_transactions": f"SELECT * FROM ({SQL['parse_feed_lines']}) WHERE {_WHOLE.replace('trans_id', 'CAST(transaction_id AS BIGINT)')}",
    "feed_rejects": f"""SELECT trans_id, CASE WHEN trans_id % 83 = 0 THEN 'surplus fields' ELSE 'missing fields' END AS reason,
        CASE WHEN trans_id % 83 = 0 THEN 9 ELSE 4 END AS fields_found, 7 AS fields_expected FROM txn WHERE NOT ({_WHOLE})""",
    "feed_blacklist": """SELECT passport_num, CAST(NULL AS VARCHAR) AS entry_dt FROM blacklist
        UNION ALL SELECT passport_num, CAST(entry_dt AS VARCHAR) FROM blacklist_feed
        WHERE passport_num NOT IN (SELECT passport_num FROM blacklist)""",
    "feed_terminals": "SELECT CAST(terminal_id AS VARCHAR) AS terminal_id, * EXCLUDE (terminal_id) FROM (" + SQL["scd2_apply"] + ")",
    "terminal_backlog": SQL["scd2_apply_series"].replace("SELECT terminal_id, CASE WHEN terminal_id % 2", "SELECT CAST(terminal_id AS VARCHAR) AS terminal_id, CASE WHEN terminal_id % 2")
    .replace("SELECT terminal_id, terminal_type, terminal_city", "SELECT CAST(terminal_id AS VARCHAR), terminal_type, terminal_city"),
    "seed_clients": """SELECT client_id, last_name, first_name, patronymic, passport_num,
        CAST(passport_valid_to AS VARCHAR) AS passport_valid_to, phone FROM clients""",
    "table_defaults": """SELECT CAST(terminal_id AS VARCHAR) AS terminal_id, terminal_type, terminal_city, terminal_address,
        TIMESTAMP '2999-12-31 23:59:59' AS effective_to, false AS deleted_flg, true AS started FROM snap""",
    "touched_days": "SELECT DISTINCT CAST(CAST(trans_date AS DATE) AS VARCHAR) AS touched FROM txn",
    "warehouse_report": "SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS report_dt FROM (" + SQL["fraud_report"].replace(
        "FROM txn t", "FROM (SELECT * REPLACE (date_trunc('second', trans_date) AS trans_date, CAST(trans_id AS VARCHAR) AS trans_id) FROM txn) t") + ")",
    "unique_keys_ledger": SQL["unique_keys_guarded"],
    "owners_by_card": """SELECT card_num, client_id, passport_num, fio, phone, CAST(passport_valid_to AS VARCHAR) AS passport_valid_to,
        CAST(account_valid_to AS VARCHAR) AS account_valid_to FROM owners""",
    "bad_document_ops_by_card": SQL["bad_document_ops"],
    "lapsed_contract_ops_by_card": SQL["lapsed_contract_ops"],
    "fraud_report_by_card": SQL["fraud_report"].replace(
        "FROM txn t", "FROM (SELECT * REPLACE (CAST(trans_id AS VARCHAR) AS trans_id) FROM txn) t"),
})


def oracle_sql() -> dict[str, str]:
    return {k: FIXTURE + v for k, v in SQL.items()}
