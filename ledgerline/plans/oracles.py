"""DuckDB oracle SQL for every checkable query of the catalog.

Each string runs on the driver's views (``orders``, ``lineitem``,
``customer`` ...) and states, in plain SQL over the flat tables, what the
Spark query computes from the landed nested report.  The derivation rules
are those of ``sources.fixtures``; the CTEs below repeat them.

Notes for DuckDB: ``//`` is integer division; ``strftime(...) || '.000'``
keeps a NULL date NULL (``concat`` would not); ``timezone(tz,
timezone('UTC', ts))`` turns a UTC wall clock into the wall clock of ``tz``.
"""

from __future__ import annotations

from ledgerline.plans.control import ETL_NAME, FILTER_COLUMN
from ledgerline.schemas import INVOICE_DATA_COLUMNS, INVOICE_SIDE, ITEM_SIDE
from ledgerline.sources import fixtures as fx

RUN_TS = 1700000000          # fixed run timestamp of the scenario queries (epoch seconds)
NEW_YORK = "America/New_York"


def fmt(ts: str, tz: str = "UTC") -> str:
    if tz == "UTC":
        return f"(strftime({ts}, '%Y-%m-%d %H:%M:%S') || '.000')"
    return f"(strftime(timezone('{tz}', timezone('UTC', {ts})), '%Y-%m-%d %H:%M:%S') || '.000')"


def _cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def _sub(key: str) -> str:
    return (f"CASE WHEN {key} % {fx.NO_SUBSCRIPTION_EVERY} = 0 THEN NULL "
            f"ELSE 's' || CAST(o_custkey % {fx.SUBSCRIPTIONS_PER_CUSTOMER} AS VARCHAR) END")


def inv_cte(tz: str = "UTC", where: str = "") -> str:
    status = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.STATUS_TEXT.items())
    total = _cents("o_totalprice")
    return f"""inv AS (
  SELECT o_orderkey,
    o_orderkey // {fx.PAGE_SIZE} AS page_no,
    CAST(o_orderkey AS VARCHAR) AS id,
    {fmt('o_orderdate', tz)} AS invoice_date,
    {fmt(f"o_orderdate + INTERVAL {fx.DUE_DAYS} DAY", tz)} AS invoice_due_date,
    {total} AS total,
    CASE WHEN o_orderstatus = 'F' THEN {total} ELSE CAST(0 AS BIGINT) END AS amount_paid,
    CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS BIGINT) ELSE {total} END AS amount_due,
    CASE WHEN o_orderstatus = 'F' THEN {fmt(f"o_orderdate + INTERVAL {fx.PAID_AFTER_DAYS} DAY", tz)} END
      AS invoice_paid_date,
    {total} // 10 AS tax,
    'c' || CAST(o_custkey AS VARCHAR) AS customer_id,
    {_sub('o_orderkey')} AS subscription_id,
    CASE o_orderstatus {status} END AS status,
    '{fx.CURRENCY}' AS currency_code
  FROM orders {where})"""


def itm_cte(tz: str = "UTC") -> str:
    amount = _cents("l_extendedprice")
    return f"""itm AS (
  SELECT l_orderkey,
    CAST(l_orderkey AS VARCHAR) AS invoice_id,
    {amount} AS amount,
    {fmt('l_shipdate', tz)} AS date_from,
    {fmt(f"l_shipdate + INTERVAL {fx.ITEM_PERIOD_DAYS} DAY", tz)} AS date_to,
    CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) AS discount_amount,
    CAST(0 AS BIGINT) AS item_level_discount_amount,
    CASE WHEN l_linenumber = {fx.MISMATCH_LINE} THEN '{fx.MISMATCH_CUSTOMER}'
         ELSE 'c' || CAST(o_custkey AS VARCHAR) END AS customer_id,
    {_sub('l_orderkey')} AS subscription_id,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
    CAST(l_quantity AS BIGINT) AS quantity,
    {amount} // CAST(l_quantity AS BIGINT) AS unit_amount,
    CAST(l_tax > 0 AS VARCHAR) AS is_taxed_item
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


INVOICE_COLS = ", ".join(["id"] + INVOICE_SIDE)
ITEM_COLS = ("invoice_id, amount, date_from, date_to, discount_amount, item_level_discount_amount, "
             "customer_id, subscription_id, id, quantity, unit_amount, is_taxed_item")
JOINED_COLS = ", ".join([f"i.{c}" for c in INVOICE_SIDE] + [f"l.{c}" for c in ITEM_SIDE])
HALF_MARK = "(SELECT max(o_orderkey) // 2 FROM orders)"


def joined_sql(null_safe: bool = False, how: str = "JOIN", extra_cols: str = "", where: str = "") -> str:
    sub = ("i.subscription_id IS NOT DISTINCT FROM l.subscription_id" if null_safe
           else "i.subscription_id = l.subscription_id")
    return f"""WITH {inv_cte(where=where)}, {itm_cte()}
SELECT {JOINED_COLS}{extra_cols}
FROM inv i {how} itm l
  ON i.id = l.invoice_id AND i.customer_id = l.customer_id AND {sub}"""


def employees_sql() -> str:
    return f"""SELECT c_custkey AS id,
  concat_ws(' ', CASE WHEN c_custkey % {fx.EMPLOYEE_NO_FIRST_NAME_EVERY} = 0 THEN NULL ELSE c_mktsegment END,
            c_name) AS name,
  CAST(c_nationkey AS BIGINT) * 21 AS steps_to_desk
FROM customer"""


def _history_rows() -> str:
    """Control table after seed + full run on the first half + incremental run."""
    def row(i, active, full, value):
        return (f"SELECT CAST({i} AS BIGINT) AS id, '{ETL_NAME}' AS etl_name, 'N' AS skip_execution, "
                f"'{active}' AS is_active, '{full}' AS full_load, CAST({RUN_TS} AS BIGINT) AS run_epoch, "
                f"'{FILTER_COLUMN}' AS filter_col1_name, {value} AS filter_col1_value, "
                f"CAST(NULL AS VARCHAR) AS filter_col2_name, CAST(NULL AS VARCHAR) AS filter_col2_value")
    marks = (f"(SELECT max(o_orderkey) AS mx, max(o_orderkey) FILTER (WHERE o_orderkey <= {HALF_MARK}) AS m1 "
             f"FROM orders) m")
    return (f"{row(1, 'N', 'Y', 'CAST(NULL AS VARCHAR)')}\n"
            f"UNION ALL {row(2, 'N', 'N', 'CAST(m1 AS VARCHAR)')} FROM {marks}\n"
            f"UNION ALL {row(3, 'Y', 'N', 'CAST(mx AS VARCHAR)')} FROM {marks}")


def _schema_rows(joined: str) -> str:
    from ledgerline.schemas import INVOICE_DATA
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS column_name, "
        f"'{f.dataType.simpleString()}' AS expected_type, '{f.dataType.simpleString()}' AS actual_type, "
        f"'ok' AS status, count({f.name}) AS non_null FROM joined"
        for i, f in enumerate(INVOICE_DATA.fields)
    ]
    return f"WITH joined AS ({joined})\n" + "\nUNION ALL ".join(parts)


def oracles() -> dict[str, str]:
    joined = joined_sql()
    incremental_target = joined_sql(
        extra_cols=f", CASE WHEN CAST(l.invoice_id AS BIGINT) <= {HALF_MARK} THEN CAST(1 AS BIGINT) "
                   f"ELSE CAST(2 AS BIGINT) END AS run_id")
    left = joined_sql(how="LEFT JOIN")
    null_checks = ", ".join(
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_{c}"
        for c in ["invoice_date", "invoice_due_date", "customer_id", "id", "date_from", "date_to"])
    any_null = " OR ".join(f"{c} IS NULL" for c in
                           ["invoice_date", "invoice_due_date", "customer_id", "id", "date_from", "date_to"])
    order_all = ", ".join(f"{c} ASC NULLS FIRST" for c in INVOICE_DATA_COLUMNS)
    return {
        "json_page_scan": f"""SELECT o_orderkey // {fx.PAGE_SIZE} AS page_no, count(*) AS n_invoices
FROM orders GROUP BY 1""",
        "json_multiline_scan": f"""SELECT o_orderkey // {fx.PAGE_SIZE} AS page_no, count(*) AS n_invoices
FROM orders GROUP BY 1""",
        "explode_invoices": f"""SELECT o_orderkey // {fx.PAGE_SIZE} AS page_no, CAST(o_orderkey AS VARCHAR) AS id,
  'c' || CAST(o_custkey AS VARCHAR) AS customer_id, {_sub('o_orderkey')} AS subscription_id,
  CASE o_orderstatus {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.STATUS_TEXT.items())} END AS status,
  CAST(coalesce(n, 0) AS BIGINT) AS n_line_items
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON l_orderkey = o_orderkey""",
        "project_invoices": f"WITH {inv_cte()} SELECT {INVOICE_COLS} FROM inv",
        "project_items": f"WITH {itm_cte()} SELECT {ITEM_COLS} FROM itm",
        "format_epoch_tz": f"""WITH {inv_cte(NEW_YORK)}
SELECT id, invoice_date, invoice_due_date, invoice_paid_date FROM inv""",
        "delta_filter": f"WITH {inv_cte(where=f'WHERE o_orderkey > {HALF_MARK}')} SELECT {INVOICE_COLS} FROM inv",
        "delta_filter_pushed": f"WITH {inv_cte(where=f'WHERE o_orderkey > {HALF_MARK}')} SELECT {INVOICE_COLS} FROM inv",
        "full_load_bypass": f"WITH {inv_cte()} SELECT {INVOICE_COLS} FROM inv",
        "join_invoice_items": joined,
        "join_invoice_items_nested": joined,
        "join_invoice_items_null_safe": joined_sql(null_safe=True),
        "join_invoice_items_left": left,
        "explode_items_outer": f"""WITH {itm_cte()}
SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, amount, date_from, date_to, discount_amount,
  item_level_discount_amount, customer_id, subscription_id, id, quantity, unit_amount, is_taxed_item
FROM orders LEFT JOIN itm ON itm.l_orderkey = o_orderkey""",
        "max_invoice_id": """SELECT max(o_orderkey) AS max_invoice_id,
  max(CAST(o_orderkey AS VARCHAR)) AS max_invoice_id_text FROM orders""",
        "mean_steps": "SELECT avg(CAST(c_nationkey AS BIGINT) * 21) AS avg_steps_to_desk FROM customer",
        "row_count": f"SELECT count(*) AS row_count FROM ({joined})",
        "employee_report": employees_sql(),
        "parquet_roundtrip": joined_sql(extra_cols=", CAST(1 AS BIGINT) AS run_id"),
        "parquet_single_file": employees_sql(),
        "ensure_table": joined,
        "inline_rows": f"""WITH {inv_cte()},
dim AS (SELECT * FROM (VALUES
  ('paid', 'Paid', false), ('payment_due', 'Payment due', true), ('posted', 'Posted', true),
  ('not_paid', 'Not paid', true), ('voided', 'Voided', false)) t(status, status_label, is_open))
SELECT dim.status_label, dim.is_open, count(*) AS n_invoices, CAST(sum(inv.total) AS BIGINT) AS total_amount
FROM inv LEFT JOIN dim ON inv.status = dim.status GROUP BY 1, 2""",
        "control_active_run": f"SELECT * FROM ({_history_rows()}) WHERE is_active = 'Y'",
        "control_close_open": _history_rows(),
        "load_empty_delta": _history_rows(),
        "watermark_cleanup": f"""SELECT id, filter_col1_value,
  COALESCE(CAST(NULLIF(filter_col1_value, 'null') AS BIGINT), 0) AS mark
FROM ({_history_rows()})""",
        "run_gate": f"""SELECT id, CASE WHEN skip_execution IS DISTINCT FROM 'N' THEN 'skip' WHEN full_load = 'Y' THEN 'full'
  WHEN full_load = 'N' THEN 'delta' ELSE 'noop' END AS action
FROM ({_history_rows()})""",
        "preview_joined": f"SELECT * FROM ({joined}) ORDER BY {order_all} LIMIT 20",
        "contract_violations": f"""SELECT count(*) AS n_rows, CAST(count(*) FILTER (WHERE {any_null}) AS BIGINT)
  AS n_violating_rows, {null_checks}
FROM ({left})""",
        "schema_check": _schema_rows(joined),
        "reconcile": f"""SELECT CAST(3 AS BIGINT) AS actual_cols, CAST(3 AS BIGINT) AS expected_cols,
  count(*) AS actual_rows, count(*) AS expected_rows,
  avg(steps_to_desk) AS actual_avg, avg(steps_to_desk) AS expected_avg,
  CAST(0 AS BIGINT) AS n_differing_rows, true AS columns_contained
FROM ({employees_sql()})""",
        "flatten_report": f"""WITH {inv_cte()}
SELECT status, count(*) AS n_invoices, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_line_items,
  CAST(sum(total) AS BIGINT) AS total_amount
FROM inv LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON l_orderkey = o_orderkey
GROUP BY status""",
        "load_full": joined_sql(extra_cols=", CAST(1 AS BIGINT) AS run_id"),
        "load_incremental": incremental_target,
        "load_replay": incremental_target,
        "stream_ingest": joined,
    }
