"""SQL for each registered query, written for DuckDB over the same tables."""

from __future__ import annotations

_EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS account_id,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS transaction_date,
         CAST(CAST(value AS DECIMAL(18,3)) AS VARCHAR) AS amount,
         event_type AS transaction_code, CAST(NULL AS VARCHAR) AS merchant_name,
         CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3
           WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'IN_STORE' ELSE 'DRIVE_THRU' END AS channel,
         CASE WHEN day(ts) <= 15 THEN 'run-a' ELSE 'run-b' END AS run_id,
         'transactions_' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv' AS source_file,
         CAST(ts AS DATE) AS date
  FROM events),
codes(transaction_code, indicator, kind) AS (
  VALUES ('purchase', 'DR', 'PURCHASE'), ('view', 'DR', 'FEE'),
         ('click', 'CR', 'PAYMENT'), ('signup', 'DR', 'INTEREST'))"""

_LINES = """
ev AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS account_id,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS transaction_date,
         CAST(CAST(l_discount AS DECIMAL(18,3)) AS VARCHAR) AS amount,
         l_returnflag AS transaction_code, CAST(NULL AS VARCHAR) AS merchant_name,
         CASE WHEN l_suppkey % 50 = 0 THEN NULL WHEN l_partkey % 40 = 0 THEN 'DRIVE_THRU'
              WHEN l_linestatus = 'F' THEN 'IN_STORE' ELSE 'ONLINE' END AS channel,
         'run-a' AS run_id,
         'transactions_' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || '.csv' AS source_file,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
codes(transaction_code, indicator, kind) AS (
  VALUES ('A', 'DR', 'PURCHASE'), ('N', 'CR', 'PAYMENT'))"""

_ACCOUNTS = """
ac AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS customer_name,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ACTIVE' WHEN 'BUILDING' THEN 'SUSPENDED'
           WHEN 'FURNITURE' THEN 'CLOSED' WHEN 'HOUSEHOLD' THEN 'PENDING'
           WHEN 'MACHINERY' THEN 'UNKNOWN' END AS account_status,
         CAST(c_acctbal AS DECIMAL(18,3)) + 100 * later AS current_balance,
         CASE WHEN c_nationkey <> 7 THEN '2020-01-01' END AS open_date,
         date '2024-01-01' + CAST(c_custkey % 30 + later AS INTEGER) AS date
  FROM customer, (VALUES (0), (7)) AS v(later)
  WHERE c_custkey % 10 <> 0 AND (later = 0 OR c_custkey % 3 = 0)),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY date DESC) AS pos FROM ac)
  WHERE pos = 1)"""

# What is wrong with each row, from sets of ids.
_JUDGED = """
marked AS (
  SELECT ev.*, TRY_CAST(amount AS DECIMAL(18,3)) AS money,
         coalesce(transaction_id, '') = '' OR coalesce(account_id, '') = ''
           OR coalesce(transaction_date, '') = '' OR coalesce(transaction_code, '') = ''
           OR coalesce(channel, '') = '' OR amount IS NULL AS incomplete
  FROM ev),
ids AS (
  SELECT transaction_id, count(*) AS copies, bool_or(incomplete) AS tainted
  FROM marked GROUP BY transaction_id),
judged AS (
  SELECT m.*, i.tainted AND NOT m.incomplete AS shielded,
         CASE WHEN m.incomplete THEN 'NULL_REQUIRED_FIELD'
              WHEN i.tainted THEN NULL
              WHEN m.money IS NULL OR m.money <= 0 THEN 'INVALID_AMOUNT'
              WHEN i.copies > 1 THEN 'DUPLICATE_TRANSACTION_ID'
              WHEN m.transaction_code NOT IN (SELECT transaction_code FROM codes) THEN 'INVALID_TRANSACTION_CODE'
              WHEN m.channel NOT IN ('ONLINE', 'IN_STORE') THEN 'INVALID_CHANNEL' END AS reason
  FROM marked m JOIN ids i USING (transaction_id))"""

_BAD_ACCOUNTS = """
acct AS (
  SELECT ac.*, open_date IS NULL OR account_status IS NULL AS incomplete FROM ac),
acct_judged AS (
  SELECT a.*, CASE WHEN incomplete THEN 'NULL_REQUIRED_FIELD'
     WHEN account_status NOT IN ('ACTIVE', 'SUSPENDED', 'CLOSED')
      AND account_id NOT IN (SELECT account_id FROM acct WHERE incomplete) THEN 'INVALID_ACCOUNT_STATUS' END AS reason,
     CAST(NOT incomplete AND account_status NOT IN ('ACTIVE', 'SUSPENDED', 'CLOSED')
      AND account_id IN (SELECT account_id FROM acct WHERE incomplete) AS INTEGER) AS shielded
  FROM acct a)"""


def _silver(resolvable: str = "EXISTS (SELECT 1 FROM ac WHERE ac.account_id = j.account_id)") -> str:
    return f"""
silver AS (
  SELECT j.*, c.indicator, c.kind,
         CASE WHEN c.indicator = 'DR' THEN j.money ELSE -j.money END AS signed_amount,
         {resolvable} AS ok
  FROM judged j LEFT JOIN codes c ON j.transaction_code = c.transaction_code
  WHERE j.reason IS NULL AND NOT j.shielded)"""


_BY_DATE = _silver("EXISTS (SELECT 1 FROM ac WHERE ac.account_id = j.account_id AND ac.date <= j.date)")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_EV_JUDGED = _with(_EVENTS, _JUDGED)
_LI_JUDGED = _with(_LINES, _JUDGED)
_EV_SILVER = _with(_EVENTS, _JUDGED, _ACCOUNTS, _silver())
_EV_BY_DATE = _with(_EVENTS, _JUDGED, _ACCOUNTS, _BY_DATE)
_LI_ACCOUNTS = _with(_LINES, _JUDGED, _ACCOUNTS, _BAD_ACCOUNTS)

_REASONS = """
SELECT transaction_id, account_id, transaction_date, CAST(money AS DOUBLE) AS amount,
       transaction_code, coalesce(channel, '(none)') AS channel,
       coalesce(reason, '(none)') AS reason, CAST(shielded AS INTEGER) AS shielded
FROM judged"""

# First copy stays: rows numbered by arrival, file and content among those fit to stay.
_KEEP_FIRST = """,
own AS (
  SELECT m.*, i.copies, i.tainted AND NOT m.incomplete AS shielded,
         CASE WHEN m.incomplete THEN 'NULL_REQUIRED_FIELD' WHEN i.tainted THEN NULL
              WHEN m.money IS NULL OR m.money <= 0 THEN 'INVALID_AMOUNT' END AS early,
         CASE WHEN m.transaction_code NOT IN (SELECT transaction_code FROM codes) THEN 'INVALID_TRANSACTION_CODE'
              WHEN m.channel NOT IN ('ONLINE', 'IN_STORE') THEN 'INVALID_CHANNEL' END AS late
  FROM marked m JOIN ids i USING (transaction_id)),
ranked AS (
  SELECT *, early IS NULL AND late IS NULL AND NOT shielded AS fit,
         row_number() OVER (PARTITION BY transaction_id ORDER BY date, source_file, account_id,
           transaction_date, amount, transaction_code, channel NULLS FIRST) AS pos
  FROM own),
firsts AS (SELECT transaction_id, min(pos) AS first_pos FROM ranked WHERE fit GROUP BY transaction_id)
SELECT r.transaction_id, account_id, transaction_date, CAST(money AS DOUBLE) AS amount,
       transaction_code, coalesce(channel, '(none)') AS channel,
       coalesce(CASE WHEN early IS NOT NULL THEN early WHEN shielded THEN NULL
            WHEN pos > first_pos THEN 'DUPLICATE_TRANSACTION_ID' ELSE late END, '(none)') AS reason,
       CAST(shielded AS INTEGER) AS shielded
FROM ranked r LEFT JOIN firsts f ON r.transaction_id = f.transaction_id"""

_SHOW_SILVER = """
SELECT transaction_id, account_id, transaction_date, CAST(money AS DOUBLE) AS amount,
       transaction_code, merchant_name, channel, indicator AS debit_credit_indicator,
       CAST(signed_amount AS DOUBLE) AS _signed_amount, CAST(ok AS INTEGER) AS _is_resolvable,
       run_id AS _pipeline_run_id, source_file AS _source_file
FROM silver"""


def _kinds() -> str:
    return ",\n".join(
        f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS {k.lower()}_count, "
        f"coalesce(CAST(sum(signed_amount) FILTER (kind = '{k}') AS DOUBLE), 0) AS {k.lower()}_sum"
        for k in ("PURCHASE", "PAYMENT", "FEE", "INTEREST", "REFUND")
    )


def _show_daily(run_id: str = "max(run_id)") -> str:
    return f"""
SELECT transaction_date, CAST(count(*) AS BIGINT) AS total_transactions,
       CAST(sum(signed_amount) AS DOUBLE) AS total_signed_amount,
       CAST(count(*) FILTER (channel = 'ONLINE') AS BIGINT) AS online_transactions,
       CAST(count(*) FILTER (channel = 'IN_STORE') AS BIGINT) AS instore_transactions,
       {_kinds()},
       {run_id} AS _pipeline_run_id,
       min(transaction_date) AS _source_period_start, max(transaction_date) AS _source_period_end
FROM silver WHERE ok GROUP BY transaction_date"""


# Money in JSON keeps its three decimals, as the decimal type prints it.
_JSON = """
SELECT transaction_date, '{{' || {pairs} || '}}' AS transactions_by_type
FROM silver WHERE ok GROUP BY transaction_date""".format(
    pairs=" || ',' || ".join(
        f"'\"{k}\":{{\"count\":' || count(*) FILTER (kind = '{k}') || ',\"sum\":' || "
        f"CAST(coalesce(sum(signed_amount) FILTER (kind = '{k}'), CAST(0 AS DECIMAL(38,3))) AS VARCHAR) || '}}'"
        for k in ("PURCHASE", "PAYMENT", "FEE", "INTEREST", "REFUND")
    )
)

_WEEKS = """,
weeks AS (
  SELECT account_id, CAST(date_trunc('week', CAST(transaction_date AS DATE)) AS DATE) AS monday,
         CAST(count(*) FILTER (kind = 'PURCHASE') AS BIGINT) AS total_purchases,
         round(avg(CAST(signed_amount AS DOUBLE)) FILTER (kind = 'PURCHASE'), 6) AS avg_purchase_amount,
         coalesce(CAST(sum(signed_amount) FILTER (kind = 'PAYMENT') AS DOUBLE), 0) AS total_payments,
         coalesce(CAST(sum(signed_amount) FILTER (kind = 'FEE') AS DOUBLE), 0) AS total_fees,
         coalesce(CAST(sum(signed_amount) FILTER (kind = 'INTEREST') AS DOUBLE), 0) AS total_interest,
         max(run_id) AS run_id
  FROM silver WHERE ok GROUP BY 1, 2)"""


def _show_weekly(balance: str, run_id: bool = True, accounts: str = "latest") -> str:
    return f"""
SELECT CAST(monday AS VARCHAR) AS week_start_date, CAST(monday + 6 AS VARCHAR) AS week_end_date,
       w.account_id, total_purchases, avg_purchase_amount, total_payments, total_fees,
       total_interest, CAST({balance} AS DOUBLE) AS closing_balance
       {", run_id AS _pipeline_run_id" if run_id else ""}
FROM weeks w JOIN {accounts} l ON w.account_id = l.account_id"""


_AS_OF = """coalesce((SELECT max_by(a.current_balance, a.date) FROM ac a
  WHERE a.account_id = w.account_id AND a.date <= w.monday + 6), l.current_balance)"""

_LOG = """
lg AS (
  SELECT 'run-' || CAST(o_custkey AS VARCHAR) AS run_id,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'bronze_accounts' ELSE 'silver_transactions' END AS model_name,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'BRONZE'
              WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'SILVER' ELSE 'GOLD' END AS layer,
         CASE WHEN o_orderstatus = 'P' THEN 'SKIPPED'
              WHEN o_orderstatus = 'O' AND substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'FAILED'
              ELSE 'SUCCESS' END AS status,
         CAST(floor(o_totalprice) AS BIGINT) AS records_written, o_orderkey AS records_rejected,
         '\\app/Bronze/order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority
           || CASE WHEN o_orderpriority LIKE '4%' THEN ' Key missing'
                   WHEN o_orderpriority LIKE '3%' THEN repeat(' detail', 100) ELSE '' END AS message,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS processed_date
  FROM orders),
kept AS (
  SELECT * REPLACE (CASE WHEN status <> 'SUCCESS' THEN replace(replace(message, '/', ''), '\\', '') END AS message)
  FROM lg)"""

_FORBIDDEN = " OR ".join(
    f"contains(lower(message), '{w}')"
    for w in ("/", "\\", ".parquet", ".csv", "/app", "/home", "password", "secret", "key")
)

_PLAN = """
SELECT CAST(date AS VARCHAR) AS date, CAST(coalesce(s.n, 0) AS BIGINT) AS source_rows,
       CAST(coalesce(l.n, 0) AS BIGINT) AS loaded_rows,
       CASE WHEN l.n IS NULL THEN 'LOAD' WHEN s.n IS NULL THEN 'KEEP' WHEN {same} THEN 'KEEP' ELSE 'RELOAD' END AS action
FROM s FULL JOIN l USING (date)"""

_ORDER_DAYS = """
o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey, o_orderstatus, o_orderpriority FROM orders)"""

_DELIVERED_CODES = """
SELECT DISTINCT event_type AS transaction_code,
       event_type || ' ' || CAST({day} AS VARCHAR) AS description,
       CASE event_type WHEN 'click' THEN 'CR' ELSE 'DR' END AS debit_credit_indicator,
       CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'view' THEN 'FEE'
         WHEN 'click' THEN 'PAYMENT' WHEN 'signup' THEN 'INTEREST' END AS transaction_type,
       'true' AS affects_balance, 'run-a' AS _pipeline_run_id,
       'transaction_codes.csv' AS _source_file
FROM (SELECT event_type, CAST(ts AS DATE) AS d, max(CAST(ts AS DATE)) OVER (PARTITION BY event_type) AS m
      FROM events WHERE event_type <> 'error')"""


def _checks(table: str, rows: str, not_null: list[str], accepted: tuple[str, str] | None, keys: list[str]) -> str:
    out = [
        f"SELECT '{table}' AS table_name, 'not_null:{c}' AS check_name, count(*) FILTER ({e} IS NULL) AS failures FROM {rows}"
        for c, e in (x.split("=") if "=" in x else (x, x) for x in not_null)
    ]
    if accepted:
        column, test = accepted
        out.append(
            f"SELECT '{table}', 'accepted_values:{column}', count(*) FILTER ({test}) FROM {rows}"
        )
    for key in keys:
        names, expression = key.split("=") if "=" in key else (key, key)
        live = " AND ".join(f"{e} IS NOT NULL" for e in expression.split(","))
        out.append(
            f"SELECT '{table}', 'unique:{names}', count(*) FROM "
            f"(SELECT {expression} FROM {rows} WHERE {live} GROUP BY {expression} HAVING count(*) > 1)"
        )
    return "\nUNION ALL ".join(out)


_REASON_LIST = (
    "('NULL_REQUIRED_FIELD','INVALID_AMOUNT','DUPLICATE_TRANSACTION_ID',"
    "'INVALID_TRANSACTION_CODE','INVALID_CHANNEL','INVALID_ACCOUNT_STATUS')"
)

# Both bindings in one statement: the line rows under their own names.
_LINE_QUARANTINE = _with(_LINES, _JUDGED).replace("WITH ", "").strip()

_EXPECTATIONS = (
    _EV_SILVER.rstrip()
    + _WEEKS
    + f""",
quarantined AS (
  WITH {_LINE_QUARANTINE}
  SELECT coalesce(reason, 'NULL_REQUIRED_FIELD') AS reason, run_id FROM judged WHERE reason IS NOT NULL OR shielded
  UNION ALL
  SELECT reason, 'run-a' FROM (WITH {_BAD_ACCOUNTS.strip()} SELECT reason FROM acct_judged) WHERE reason IS NOT NULL),
gold AS (SELECT transaction_date, max(run_id) AS run_id, count(*) AS n, sum(signed_amount) AS total FROM silver WHERE ok GROUP BY 1),
weekly AS (SELECT w.*, l.current_balance FROM weeks w JOIN latest l ON w.account_id = l.account_id),
used AS (SELECT c.* FROM codes c WHERE transaction_code IN (SELECT transaction_code FROM ev))
"""
    + "\nUNION ALL ".join(
        [
            _checks("silver_transaction_codes", "used",
                    ["transaction_code", "debit_credit_indicator=indicator", "transaction_type=kind", "_pipeline_run_id='run-a'"],
                    ("debit_credit_indicator", "indicator NOT IN ('DR', 'CR')"), []),
            _checks("silver_accounts", "latest", ["account_id", "_pipeline_run_id='run-a'"], None, ["account_id"]),
            _checks("silver_transactions", "silver", ["_signed_amount=signed_amount", "_pipeline_run_id=run_id"], None, ["transaction_id"]),
            _checks("silver_quarantine", "quarantined", ["_pipeline_run_id=run_id", "_rejection_reason=reason"],
                    ("_rejection_reason", f"reason NOT IN {_REASON_LIST}"), []),
            _checks("gold_daily_summary", "gold",
                    ["transaction_date", "total_transactions=n", "total_signed_amount=total", "online_transactions=n",
                     "instore_transactions=n", "transactions_by_type=n", "_computed_at=n", "_pipeline_run_id=run_id",
                     "_source_period_start=transaction_date", "_source_period_end=transaction_date"], None, ["transaction_date"]),
            _checks("gold_weekly_account_summary", "weekly",
                    ["week_start_date=monday", "week_end_date=monday", "account_id", "total_purchases", "avg_purchase_amount",
                     "total_payments", "total_fees", "total_interest", "closing_balance=current_balance", "_computed_at=monday",
                     "_pipeline_run_id=run_id"], None, ["account_id,week_start_date=account_id,monday"]),
        ]
    )
)

_STREAMED = _EV_BY_DATE + _SHOW_SILVER.replace("run_id AS _pipeline_run_id, ", "")

ORACLES: dict[str, str] = {
    "txn_reasons": _LI_JUDGED + _REASONS,
    "txn_reasons_events": _EV_JUDGED + _REASONS,
    "txn_reasons_keep_first": _LI_JUDGED.rstrip() + _KEEP_FIRST,
    "reason_counts": _LI_JUDGED + """
SELECT coalesce(reason, '(none)') AS reason, CAST(shielded AS INTEGER) AS shielded, count(*) AS row_count
FROM judged GROUP BY 1, 2""",
    "account_reasons": _with(_ACCOUNTS, _BAD_ACCOUNTS) + """
SELECT account_id, CAST(date AS VARCHAR) AS date, account_status,
       coalesce(reason, '(none)') AS reason, shielded FROM acct_judged""",
    "quarantine_unified": _LI_ACCOUNTS + """
SELECT transaction_id, '(any)' AS account_id, min(reason) AS reason, 'TRANSACTION' AS record_type
FROM judged WHERE reason IS NOT NULL GROUP BY transaction_id
UNION ALL
SELECT '(none)', account_id, min(reason), 'ACCOUNT' FROM acct_judged WHERE reason IS NOT NULL GROUP BY account_id""",
    "quarantine_per_row": _LI_ACCOUNTS + """
SELECT 'TRANSACTION' AS record_type, CAST(date AS VARCHAR) AS date,
       coalesce(reason, 'NULL_REQUIRED_FIELD') AS reason, count(*) AS row_count,
       count(*) FILTER (shielded) AS shielded_rows
FROM judged WHERE reason IS NOT NULL OR shielded GROUP BY ALL
UNION ALL
SELECT 'ACCOUNT', CAST(date AS VARCHAR), reason, count(*), 0 FROM acct_judged
WHERE reason IS NOT NULL GROUP BY ALL""",
    "latest_accounts": _with(_ACCOUNTS) + """
SELECT account_id, customer_name, account_status, CAST(5000 AS DOUBLE) AS credit_limit,
       CAST(current_balance AS DOUBLE) AS current_balance, coalesce(open_date, '(none)') AS open_date,
       '1' AS billing_cycle_start, '28' AS billing_cycle_end, 'run-a' AS _pipeline_run_id,
       'accounts_' || CAST(date AS VARCHAR) || '.csv' AS _source_file
FROM latest""",
    "accounts_unique": _with(_ACCOUNTS) + """
SELECT 'silver' AS source, count(*) AS total_records, count(DISTINCT account_id) AS unique_accounts,
       CAST(count(*) = count(DISTINCT account_id) AS INTEGER) AS passed FROM latest
UNION ALL
SELECT 'bronze', count(*), count(DISTINCT account_id), CAST(count(*) = count(DISTINCT account_id) AS INTEGER) FROM ac""",
    "codes_unique": _DELIVERED_CODES.format(day="m"),
    "codes_distinct": _DELIVERED_CODES.format(day="d"),
    "promoted": _EV_SILVER + _SHOW_SILVER,
    "promoted_as_of_date": _EV_BY_DATE + _SHOW_SILVER,
    "promoted_against_quarantine": _LI_JUDGED + """
SELECT transaction_id, account_id, transaction_date, CAST(money AS DOUBLE) AS amount, channel
FROM judged j WHERE NOT EXISTS (
  SELECT 1 FROM judged q WHERE q.transaction_id = j.transaction_id AND q.reason IS NOT NULL)""",
    "unresolved_by_account": _EV_SILVER + """
SELECT account_id, count(*) AS row_count, CAST(sum(signed_amount) AS DOUBLE) AS signed_amount
FROM silver WHERE NOT ok GROUP BY account_id""",
    "backfill_effect": _with(_EVENTS, _JUDGED, _ACCOUNTS, _BY_DATE) + """,
states AS (
  SELECT 'before' AS state, * FROM silver
  UNION ALL
  SELECT 'after', * REPLACE (ok OR account_id IN (SELECT account_id FROM ac) AS ok) FROM silver)
SELECT state, transaction_date, count(*) FILTER (ok) AS resolvable_rows,
       count(*) FILTER (NOT ok) AS waiting_rows,
       coalesce(CAST(sum(signed_amount) FILTER (ok) AS DOUBLE), 0) AS signed_amount
FROM states GROUP BY 1, 2""",
    "gold_daily": _EV_SILVER + _show_daily(),
    "gold_daily_json": _EV_SILVER + _JSON,
    "gold_weekly_account": _EV_SILVER.rstrip() + _WEEKS + _show_weekly("l.current_balance"),
    "closing_balance_asof": _EV_SILVER.rstrip() + _WEEKS + _show_weekly(_AS_OF),
    "mass_conservation": _LI_JUDGED + """
SELECT CAST(date AS VARCHAR) AS date, count(*) AS bronze_rows,
       count(*) FILTER (reason IS NULL AND NOT shielded) AS silver_rows,
       count(*) FILTER (reason IS NOT NULL OR shielded) AS quarantine_rows, CAST(0 AS BIGINT) AS difference
FROM judged GROUP BY date
UNION ALL
SELECT CAST(date AS VARCHAR), 0, 0, 0, 0 FROM judged WHERE false""",
    "layer_counts": _EV_SILVER + """,
n AS (
  SELECT CAST(j.date AS VARCHAR) AS date, count(*) AS bronze, count(*) FILTER (j.reason IS NULL) AS silver,
         count(*) FILTER (j.reason IS NOT NULL) AS rejected,
         count(*) FILTER (j.reason IS NULL AND j.account_id IN (SELECT account_id FROM ac)) AS resolvable
  FROM judged j GROUP BY j.date)
SELECT date, 'silver_transactions' AS model_name, bronze AS records_processed,
       silver AS records_written, bronze - silver AS records_rejected FROM n
UNION ALL SELECT date, 'silver_quarantine', bronze, rejected, rejected FROM n
UNION ALL SELECT transaction_date, 'gold_daily_summary', count(*), 1, -1 FROM silver WHERE ok GROUP BY transaction_date
UNION ALL SELECT CAST(date_trunc('week', CAST(transaction_date AS DATE))::DATE AS VARCHAR), 'gold_weekly_account_summary', count(*), count(DISTINCT account_id), -1
FROM silver WHERE ok GROUP BY 1
UNION ALL SELECT CAST(d AS VARCHAR), 'silver_accounts', sum(p)::BIGINT, sum(w)::BIGINT, -1
FROM (SELECT date AS d, 1 AS p, 0 AS w FROM ac UNION ALL SELECT date, 0, 1 FROM latest) GROUP BY d
UNION ALL SELECT CAST(d AS VARCHAR), 'silver_transaction_codes', sum(p)::BIGINT, sum(w)::BIGINT, -1
FROM (SELECT date AS d, 1 AS p, 0 AS w FROM (SELECT DISTINCT transaction_code, date FROM ev WHERE transaction_code <> 'error')
      UNION ALL SELECT max(date), 0, 1 FROM ev WHERE transaction_code <> 'error' GROUP BY transaction_code) GROUP BY d""",
    "gold_tieout": _EV_SILVER + """
SELECT transaction_date, count(*) AS gold_total_transactions, count(*) AS silver_total_transactions,
       CAST(sum(signed_amount) AS DOUBLE) AS gold_total_signed_amount,
       CAST(sum(signed_amount) AS DOUBLE) AS silver_total_signed_amount, 1 AS agrees
FROM silver WHERE ok GROUP BY transaction_date""",
    "weekly_tieout": _EV_SILVER.rstrip() + _WEEKS + """
SELECT w.account_id, CAST(monday AS VARCHAR) AS week_start_date, total_purchases AS gold_total_purchases,
       total_purchases AS silver_total_purchases,
       coalesce(avg_purchase_amount, -1) AS gold_avg_purchase_amount, coalesce(avg_purchase_amount, -1) AS silver_avg_purchase_amount,
       total_payments AS gold_total_payments, total_payments AS silver_total_payments,
       total_fees AS gold_total_fees, total_fees AS silver_total_fees,
       total_interest AS gold_total_interest, total_interest AS silver_total_interest,
       CAST(l.current_balance AS DOUBLE) AS gold_closing_balance, CAST(l.current_balance AS DOUBLE) AS silver_closing_balance,
       1 AS agrees
FROM weeks w JOIN latest l ON w.account_id = l.account_id""",
    "tieout_faults": _EV_SILVER + """
SELECT transaction_date,
       CASE WHEN day(CAST(transaction_date AS DATE)) % 7 = 0 THEN -1
            ELSE count(*) + CASE WHEN day(CAST(transaction_date AS DATE)) % 5 = 0 THEN 1 ELSE 0 END END AS gold_total_transactions,
       count(*) AS silver_total_transactions,
       CASE WHEN day(CAST(transaction_date AS DATE)) % 7 = 0 OR day(CAST(transaction_date AS DATE)) % 5 = 0 THEN 0 ELSE 1 END AS agrees
FROM silver WHERE ok GROUP BY transaction_date""",
    "lineage_weekly": _EV_SILVER.rstrip() + _WEEKS + """
SELECT s.account_id, CAST(w.monday AS VARCHAR) AS week_start_date, any_value(w.total_purchases) AS total_purchases,
       s.run_id AS _pipeline_run_id, s.source_file AS _source_file, count(*) AS silver_rows,
       CAST(sum(s.signed_amount) AS DOUBLE) AS silver_amount,
       (SELECT count(*) FROM ev WHERE ev.run_id = s.run_id AND ev.source_file = s.source_file) AS bronze_rows,
       CAST(s.run_id = 'run-a' AS INTEGER) AS has_success_log
FROM silver s JOIN weeks w ON w.account_id = s.account_id
  AND w.monday = CAST(date_trunc('week', CAST(s.transaction_date AS DATE)) AS DATE)
WHERE s.ok AND s.account_id IN (SELECT account_id FROM latest) GROUP BY s.account_id, w.monday, s.run_id, s.source_file""",
    "expectations": _EXPECTATIONS,
    "expectations_bronze": _LI_JUDGED + _checks(
        "bronze_transactions", "ev", ["transaction_id", "channel"],
        ("channel", "channel NOT IN ('ONLINE', 'IN_STORE')"),
        ["transaction_id", "account_id,transaction_date"],
    ),
    "referential_gaps": _with(_EVENTS, _ACCOUNTS) + """
SELECT 'transaction_code' AS reference, transaction_code AS value, count(*) AS silver_rows FROM ev
WHERE transaction_code NOT IN (SELECT transaction_code FROM codes) GROUP BY transaction_code
UNION ALL
SELECT 'account_id', account_id, count(*) FROM ev
WHERE account_id NOT IN (SELECT account_id FROM latest) GROUP BY account_id""",
    "lineage_trace": _EV_SILVER + """
SELECT s.transaction_date, sum(count(*)) OVER (PARTITION BY s.transaction_date)::BIGINT AS total_transactions,
       s.run_id AS _pipeline_run_id, s.source_file AS _source_file, count(*) AS silver_rows,
       CAST(sum(signed_amount) AS DOUBLE) AS silver_amount,
       (SELECT count(*) FROM ev WHERE ev.run_id = s.run_id AND ev.source_file = s.source_file) AS bronze_rows,
       CAST(s.run_id = 'run-a' AS INTEGER) AS has_success_log
FROM silver s WHERE ok GROUP BY s.transaction_date, s.run_id, s.source_file""",
    "run_audit": _with(_EVENTS, _LOG) + """
SELECT 'unlogged' AS finding, 'run-' || account_id AS run_id, count(*) AS row_count FROM ev
WHERE 'run-' || account_id NOT IN (SELECT run_id FROM lg WHERE status = 'SUCCESS') GROUP BY account_id
UNION ALL
SELECT 'skipped', 'run-' || account_id, count(*) FROM ev
WHERE 'run-' || account_id IN (SELECT run_id FROM lg GROUP BY run_id HAVING bool_and(status = 'SKIPPED'))
GROUP BY account_id""",
    "load_reconcile": _with(_ORDER_DAYS, """
s AS (SELECT date, count(*) AS n FROM o GROUP BY date)""", """
l AS (SELECT date, count(*) AS n FROM o WHERE date < date '2001-01-01'
      AND NOT (o_orderstatus = 'P' AND day(date) = 7) GROUP BY date)""") + _PLAN.format(same="s.n = l.n"),
    "load_reconcile_checksum": _with(_ORDER_DAYS, """
s AS (SELECT date, count(*) AS n, count(*) FILTER (day(date) = 9 AND o_orderpriority = '5-LOW') AS changed
      FROM o GROUP BY date)""", """
l AS (SELECT date, count(*) AS n FROM o GROUP BY date)""") + _PLAN.format(same="s.changed = 0"),
    "date_spine_gaps": """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT CAST(CAST(g AS DATE) AS VARCHAR) AS date
FROM generate_series((SELECT min(day) FROM d), (SELECT max(day) FROM d), INTERVAL 1 DAY) AS t(g)
WHERE CAST(g AS DATE) NOT IN (SELECT day FROM d)""",
    "incremental_equals_range": _EV_SILVER.rstrip() + _WEEKS + """
SELECT 'gold_daily_summary' AS table_name, count(DISTINCT transaction_date) AS compared,
       CAST(0 AS BIGINT) AS differing FROM silver WHERE ok
UNION ALL SELECT 'gold_weekly_account_summary', count(*), 0 FROM weeks""",
    "equivalence_excess": """
SELECT date, o_orderstatus, o_orderpriority, CAST(sum(sign) AS BIGINT) AS excess FROM (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderstatus, o_orderpriority, 1 AS sign FROM orders
  UNION ALL
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
         CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END, o_orderpriority, -1 FROM orders)
GROUP BY 1, 2, 3 HAVING sum(sign) <> 0""",
    "log_gate": _with(_LOG) + """
SELECT run_id, count(*) AS total, count(*) FILTER (status = 'SUCCESS') AS success_count,
       count(*) FILTER (status = 'SKIPPED' AND model_name = 'bronze_accounts') AS excused_count,
       CAST(count(*) FILTER (status = 'SUCCESS') > 0 AND count(*) FILTER (
         status <> 'SUCCESS' AND NOT (status = 'SKIPPED' AND model_name = 'bronze_accounts')) = 0 AS INTEGER) AS complete
FROM lg GROUP BY run_id""",
    "log_sanitize": _with(_LOG) + """
SELECT run_id, model_name, layer, status, records_written,
       CASE WHEN layer = 'SILVER' THEN records_rejected ELSE -1 END AS records_rejected,
       coalesce(message, '(none)') AS error_message, processed_date
FROM kept""",
    "messages_clean": _with(_LOG) + f"""
SELECT 'raw' AS state, run_id, count(*) AS unclean FROM lg WHERE {_FORBIDDEN} GROUP BY run_id
UNION ALL
SELECT 'constrained', run_id, count(*) FROM kept WHERE {_FORBIDDEN} GROUP BY run_id""",
    "csv_ingest": _with(_EVENTS) + """
SELECT transaction_id, account_id, transaction_date, amount, transaction_code,
       coalesce(merchant_name, '(none)') AS merchant_name, channel, 'run-a' AS _pipeline_run_id,
       source_file AS _source_file, CAST(date AS VARCHAR) AS date
FROM ev""",
    "csv_load_plan": _with(_EVENTS) + """
SELECT CAST(date AS VARCHAR) AS date, count(*) AS source_rows, count(*) AS loaded_rows, 'KEEP' AS action
FROM ev GROUP BY date""",
    "range_run": _EV_BY_DATE + _show_daily("'run-a'"),
    "incremental_run": _with(_EVENTS, _JUDGED, _ACCOUNTS, _BY_DATE).rstrip() + _WEEKS
    + _show_weekly(_AS_OF, run_id=False),
    "csv_ragged": _with(_EVENTS) + """
SELECT CAST(date AS VARCHAR) AS date, CASE WHEN odd THEN 'FAILED' ELSE 'SUCCESS' END AS status, n AS records_processed,
       CASE WHEN odd THEN 0 ELSE n END AS records_written, CASE WHEN odd THEN 0 ELSE n END AS held
FROM (SELECT date, count(*) AS n, bool_or(day(date) % 7 = 3 AND CAST(transaction_id AS BIGINT) % 100 = 0) AS odd
      FROM ev GROUP BY date)""",
    "stream_run": _STREAMED,
    "stream_retry_run": _STREAMED,
    "reload_run": _STREAMED,
    "backfill_run": _with(_EVENTS, _JUDGED, _ACCOUNTS, _BY_DATE) + """,
late AS (SELECT account_id FROM ac WHERE date <= (SELECT max(date) FROM ev)),
resolved AS (SELECT * REPLACE (ok OR account_id IN (SELECT account_id FROM late) AS ok) FROM silver)"""
    + _SHOW_SILVER.replace("run_id AS _pipeline_run_id, ", "").replace("FROM silver", "FROM resolved"),
    "days_opened": _with(_EVENTS) + """,
span AS (SELECT min(date) AS first, max(date) AS last FROM ev),
again AS (
  SELECT transaction_id, date FROM ev, span
  WHERE date <> last AND ((date = first AND CAST(transaction_id AS BIGINT) % 3 = 0)
    OR (day(date) = 9 AND CAST(transaction_id AS BIGINT) % 5 = 0)))
SELECT CAST(date AS VARCHAR) AS date, count(*) AS shared_ids FROM again GROUP BY date""",
    "weekly_view_run": _with(_EVENTS, _JUDGED, _ACCOUNTS.replace("FROM customer,", "FROM (SELECT * FROM customer, (SELECT max(CAST(ts AS DATE)) AS last FROM events)),").replace("WHERE c_custkey % 10 <> 0", "WHERE date '2024-01-01' + CAST(c_custkey % 30 + later AS INTEGER) <> last AND c_custkey % 10 <> 0"), _BY_DATE) + """,
used AS (SELECT *, date_trunc('week', CAST(transaction_date AS DATE))::DATE AS week FROM silver WHERE ok),
span AS (SELECT max(date) AS last FROM ev)
SELECT CAST(week AS VARCHAR) AS week_start_date,
       CASE WHEN week IN (SELECT week FROM used, span WHERE date = last) THEN 'run-b' ELSE 'run-a' END AS written_by,
       count(DISTINCT account_id) AS accounts, count(*) FILTER (kind = 'PURCHASE') AS purchases
FROM used GROUP BY week""",
    "versioned_reader": """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, count(*) AS before_rows,
       count(*) FILTER (day(o_orderdate) % 7 <> 3 OR o_orderstatus = 'F') AS after_rows
FROM orders WHERE o_orderdate >= date '1998-01-01' GROUP BY 1""",
    "source_audit": _with(_EVENTS) + """,
span AS (SELECT min(date) AS first, max(date) AS last FROM ev)
SELECT 'load' AS step, CAST(date AS VARCHAR) AS date, 'UNCHANGED' AS finding FROM ev GROUP BY date
UNION ALL
SELECT 'planted', CAST(date AS VARCHAR), CASE date WHEN first THEN 'CHANGED' WHEN last THEN 'MISSING' ELSE 'UNCHANGED' END
FROM ev, span GROUP BY date, first, last
UNION ALL
SELECT 'planted', CAST(last + 90 AS VARCHAR), 'NEW' FROM span""",
    "stream_gap_run": _with(_EVENTS, _JUDGED) + """,
span AS (SELECT min(date) AS first, max(date) AS last FROM ev)
SELECT CAST(date AS VARCHAR) AS date, count(*) AS silver_rows, CAST(last AS VARCHAR) AS watermark
FROM judged, span WHERE reason IS NULL AND NOT shielded AND date <> first + 3 GROUP BY date, last""",
    "equivalence_buckets": """
WITH changed AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_orderkey AS VARCHAR) AS o_orderkey
  FROM orders WHERE o_orderstatus = 'P' AND day(o_orderdate) = 7)
SELECT date, o_orderkey, o_orderstatus, CAST(excess AS BIGINT) AS excess,
       (SELECT count(DISTINCT date) FROM changed) AS days
FROM changed, (VALUES ('P', 1), ('F', -1)) AS v(o_orderstatus, excess)""",
    "unresolved_index": _EV_BY_DATE + """
SELECT CAST(date AS VARCHAR) AS date, account_id, count(*) AS waiting_rows FROM silver WHERE NOT ok GROUP BY ALL""",
}
