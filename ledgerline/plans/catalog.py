"""Query catalog: one callable per operator of the inventory.

Every query takes ``(spark, sf_dir)``, reads the driver's tables (through
the report landed from them, see ``sources.report``) and returns a
DataFrame whose columns carry the same names as the oracle SQL in
``plans.oracles``.  The report is landed, and flattened for the joins, by the first
query that needs it; apart from that, and from the scenarios and writes below,
building a query starts no job.  No query depends on the session time zone or on row
order.

Scenario queries (loads, control table) run the job against fresh folders
under the shared scratch root; a scenario runs once per process and sf
folder, and its written tables are read back by every query that needs them.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import clean_watermark
from ledgerline.operators import checks, flatten, join, metrics, people
from ledgerline.plans import control
from ledgerline.plans.oracles import NEW_YORK, RUN_TS
from ledgerline.plans.runs import LoadSettings, read_published, run_load
from ledgerline.session import fresh_dir
from ledgerline.sinks import parquet as pq
from ledgerline.sources import (
    fixtures, flat_driver_report, inline_rows, land_driver_fetches, land_driver_report, land_pages, read_parquet, read_report,
)
from ledgerline.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

_SCENARIOS: dict[tuple, object] = {}
_SCENARIO_LOCK = threading.Lock()


# ------------------------------------------------------------------ helpers

# What the item side of the report needs: the invoice's id and whole items.
_ITEM_PAGES = schemas.page_schema(("id",), None)


def _pages(spark: SparkSession, sf_dir: str, headers_only: bool = False, schema=None) -> DataFrame:
    """Landed pages.  Catalyst does not prune nested JSON fields, so queries
    that need only some fields pass a narrower schema themselves (see
    ``schemas.page_schema``): the parser skips the rest instead of building it."""
    if schema is None:
        schema = schemas.PAGE_HEADERS_ONLY if headers_only else schemas.PAGE
    return read_report(spark, land_driver_report(spark, sf_dir), schema=schema)


def _flat(spark: SparkSession, sf_dir: str, headers_only: bool = False, schema=None) -> DataFrame:
    return flatten.explode_invoices(_pages(spark, sf_dir, headers_only, schema))


def _joined(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """JON-01 from the flattened report, strategy chosen as a load does.

    The report is parsed once into the flat set, with the answer whether its ids are
    unique stored beside it; so this reads columnar Parquet and starts no job.
    """
    flat, unique = flat_driver_report(spark, sf_dir)
    return join.join_flat(flat, strategy="nested" if unique else "shuffle", **options)


def _half_mark(spark: SparkSession, sf_dir: str) -> int:
    """Half of the largest order key: the mark of the 'previous run'."""
    top = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.max("o_orderkey")).first()[0]
    return int(top) // 2


def _history_view(history: DataFrame) -> DataFrame:
    """Control rows with the run time as epoch seconds (zone independent)."""
    return history.select(
        "id", "etl_name", "skip_execution", "is_active", "full_load",
        F.unix_seconds("run_date").alias("run_epoch"),
        "filter_col1_name", "filter_col1_value", "filter_col2_name", "filter_col2_value",
    )


def _memo(key: tuple, build):
    """Build a scenario once per key, also when queries are called from several threads."""
    with _SCENARIO_LOCK:
        if key not in _SCENARIOS:
            _SCENARIOS[key] = build()
        return _SCENARIOS[key]


def _settings(spark: SparkSession, report_path: str) -> LoadSettings:
    base = fresh_dir(spark, "scenario")
    return LoadSettings(report_path=report_path, target_path=f"{base}/target",
                        control_path=f"{base}/control", lake_path=f"{base}/lake")


def _full_scenario(spark: SparkSession, sf_dir: str) -> LoadSettings:
    def build():
        s = _settings(spark, land_driver_report(spark, sf_dir))
        control.RunHistory(spark, s.control_path).seed(run_ts=RUN_TS)
        run_load(spark, s, run_ts=RUN_TS)
        return s
    return _memo(("full", sf_dir, id(spark.sparkContext)), build)


def _incremental_scenario(spark: SparkSession, sf_dir: str, crash: bool = False) -> LoadSettings:
    """Seed, full load of a first fetch with the lower half of the invoices, incremental
    load of a second one that begins at a quarter: the run opens that fetch only, and the
    mark leaves out what the first one held.

    With ``crash`` an earlier attempt of the incremental run has left other
    rows in a folder of its own without being published.
    """
    def build():
        half = _half_mark(spark, sf_dir)
        s = _settings(spark, land_driver_fetches(spark, sf_dir, [(None, half), (half // 2, None)]))
        control.RunHistory(spark, s.control_path).seed(run_ts=RUN_TS)
        run_load(spark, replace(s, up_to_fetch="fetch-1"), run_ts=RUN_TS)
        if crash:
            pq.write_attempt(read_published(spark, s), s.target_path, 2, "crashed")
        run_load(spark, s, run_ts=RUN_TS)
        return s
    return _memo(("incremental", crash, sf_dir, id(spark.sparkContext)), build)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _incremental_scenario(spark, sf_dir)
    return control.RunHistory(spark, s.control_path).table()


# ------------------------------------------------------------------ queries

def json_page_scan(spark, sf_dir):
    """SRC-01 + SRC-02: scan the landed pages; invoices per page."""
    narrow = schemas.page_schema(invoice_fields=("id",), item_fields=())
    return _pages(spark, sf_dir, schema=narrow).select(
        "page_no", F.size("list").cast("bigint").alias("n_invoices"))


def json_multiline_scan(spark, sf_dir):
    """SRC-01 as the reference reads it: one JSON document per file, ``multiLine``."""
    narrow = schemas.page_schema(invoice_fields=("id",), item_fields=())
    path = land_driver_report(spark, sf_dir, layout="documents")
    return read_report(spark, path, schema=narrow, multiline=True).select(
        "page_no", F.size("list").cast("bigint").alias("n_invoices"))


def explode_invoices(spark, sf_dir):
    """PRJ-02 + PRJ-03: one row per invoice, sibling column kept."""
    inv = F.col(flatten.INV)
    narrow = schemas.page_schema(("id", "customer_id", "subscription_id", "status"), ("id",))
    return _flat(spark, sf_dir, schema=narrow).select(
        "page_no", inv["id"].alias("id"), inv["customer_id"].alias("customer_id"),
        inv["subscription_id"].alias("subscription_id"), inv["status"].alias("status"),
        F.size(inv["line_items"]).cast("bigint").alias("n_line_items"))


def project_invoices(spark, sf_dir):
    """PRJ-01 + PRJ-05 + DT-01."""
    return flatten.project_invoices(_flat(spark, sf_dir, headers_only=True))


def project_items(spark, sf_dir):
    """PRJ-04 + PRJ-06 + TYP-01."""
    return flatten.project_items(_flat(spark, sf_dir, schema=_ITEM_PAGES))


def format_epoch_tz(spark, sf_dir):
    """DT-02: the invoice dates in New York time."""
    return flatten.project_invoices(_flat(spark, sf_dir, headers_only=True), tz=NEW_YORK).select(
        "id", "invoice_date", "invoice_due_date", "invoice_paid_date")


def delta_filter(spark, sf_dir):
    """FLT-01 on the exploded rows (the reference's placement)."""
    flat = flatten.delta_filter(_flat(spark, sf_dir, headers_only=True), _half_mark(spark, sf_dir))
    return flatten.project_invoices(flat)


def delta_filter_pushed(spark, sf_dir):
    """FLT-01 applied to the array before the explode (same rows)."""
    flat = flatten.explode_invoices_since(_pages(spark, sf_dir, headers_only=True), _half_mark(spark, sf_dir))
    return flatten.project_invoices(flat)


def full_load_bypass(spark, sf_dir):
    """FLT-02: a zero mark selects everything."""
    flat = flatten.delta_filter(_flat(spark, sf_dir, headers_only=True), 0)
    return flatten.project_invoices(flat)


def join_invoice_items(spark, sf_dir):
    """JON-01 + PRJ-07 as the relational join of the two projections."""
    return join.join_invoice_items(flatten.project_invoices(_flat(spark, sf_dir, headers_only=True)),
                                   flatten.project_items(_flat(spark, sf_dir, schema=_ITEM_PAGES)))


def join_invoice_items_nested(spark, sf_dir):
    """JON-01 without a shuffle (ids are unique in the landed report)."""
    return _joined(spark, sf_dir)


def join_invoice_items_null_safe(spark, sf_dir):
    """JON-01 option: NULL subscriptions match each other."""
    return _joined(spark, sf_dir, null_safe=True)


def join_invoice_items_left(spark, sf_dir):
    """JON-01 option: invoices without a matching item are kept."""
    return _joined(spark, sf_dir, how="left")


def explode_items_outer(spark, sf_dir):
    """PRJ-03 option: invoices without items keep one row of NULL item fields."""
    return flatten.project_items(_flat(spark, sf_dir, schema=_ITEM_PAGES), outer=True)


def max_invoice_id(spark, sf_dir):
    """AGG-01: numeric high-water mark (and the lexicographic one, for contrast)."""
    flat = _flat(spark, sf_dir, schema=schemas.page_schema(("id",), ()))
    return metrics.max_invoice_id(flat.select(F.col(flatten.INV)["id"].alias("id")))


def _employee_report(spark, sf_dir):
    return people.transform_employees(fixtures.employees(spark, sf_dir))


def mean_steps(spark, sf_dir):
    """AGG-02."""
    return metrics.mean_of(_employee_report(spark, sf_dir), "steps_to_desk", "avg_steps_to_desk")


def row_count(spark, sf_dir):
    """AGG-03 over the joined set."""
    return metrics.row_count(_joined(spark, sf_dir))


def employee_report(spark, sf_dir):
    """FLOW-04 + STR-01 + MTH-01."""
    return _employee_report(spark, sf_dir)


def parquet_roundtrip(spark, sf_dir):
    """SNK-03 + SRC-03: the joined set written as run partition 1 and read back."""
    path = fresh_dir(spark, "roundtrip")
    pq.write_run_partition(_joined(spark, sf_dir), path, run_id=1)
    return read_parquet(spark, path, pq.with_run_column(schemas.INVOICE_DATA))


def parquet_single_file(spark, sf_dir):
    """SNK-04: a table written as one file, as asked for, and read back."""
    path = fresh_dir(spark, "single")
    pq.write_files(_employee_report(spark, sf_dir), path, n_files=1)
    return read_parquet(spark, path)


def ensure_table(spark, sf_dir):
    """SNK-05: create the target with the DDL schema, insert by name, read back."""
    path = fresh_dir(spark, "ensure")
    pq.ensure_table(spark, path, schemas.INVOICE_DATA_DDL)
    joined = _joined(spark, sf_dir)
    pq.insert_into(pq.conform(joined, schemas.INVOICE_DATA_DDL), path)
    return read_parquet(spark, path, schemas.INVOICE_DATA_DDL)


# Display labels of the invoice statuses (our own choice).
STATUS_LABELS = [
    ("paid", "Paid", False),
    ("payment_due", "Payment due", True),
    ("posted", "Posted", True),
    ("not_paid", "Not paid", True),
    ("voided", "Voided", False),
]


def inline_rows_query(spark, sf_dir):
    """SRC-04: an inline lookup table joined to the invoices (broadcast: 5 rows)."""
    dim = inline_rows(spark, STATUS_LABELS, "status string, status_label string, is_open boolean")
    inv = flatten.project_invoices(_flat(spark, sf_dir, headers_only=True))
    return (inv.join(F.broadcast(dim), "status", "left")
            .groupBy("status_label", "is_open")
            .agg(F.count(F.lit(1)).alias("n_invoices"), F.sum("total").alias("total_amount")))


def control_active_run(spark, sf_dir):
    """SRC-05 + FLT-03 + LIM-01 after a full and an incremental run."""
    s = _incremental_scenario(spark, sf_dir)
    return _history_view(control.RunHistory(spark, s.control_path).active_run())


def control_close_open(spark, sf_dir):
    """CTL-01 + CTL-02 + CTL-03 + DT-03: the whole control table."""
    return _history_view(_history(spark, sf_dir))


def load_empty_delta(spark, sf_dir):
    """FLT-05: a further run finds no new invoice and leaves the control table as it is."""
    s = _incremental_scenario(spark, sf_dir)
    outcome = run_load(spark, s, run_ts=RUN_TS)
    if outcome.status != "empty":
        raise AssertionError(f"expected an empty delta, got {outcome}")
    return _history_view(control.RunHistory(spark, s.control_path).table())


def watermark_cleanup(spark, sf_dir):
    """FLT-04 over the stored marks."""
    return _history(spark, sf_dir).select(
        "id", "filter_col1_value", clean_watermark("filter_col1_value").alias("mark"))


def run_gate(spark, sf_dir):
    """FLT-06: the action each control row would trigger."""
    return control.with_action(_history(spark, sf_dir)).select("id", "action")


def preview_joined(spark, sf_dir):
    """LIM-02: the first 20 joined rows in a total order."""
    return metrics.preview(_joined(spark, sf_dir), 20)


def contract_violations(spark, sf_dir):
    """SC-02 over the left-joined set (invoices without items violate it)."""
    left = _joined(spark, sf_dir, how="left")
    return checks.contract_violations(left, schemas.INVOICE_DATA_NOT_NULL)


def schema_check(spark, sf_dir):
    """SC-01: the joined set against the declared target schema, with non-NULL counts."""
    joined = _joined(spark, sf_dir)
    return checks.schema_diff(spark, joined, schemas.INVOICE_DATA, profile=True)


def reconcile(spark, sf_dir):
    """SC-03: the employee transform against an independent SQL formulation."""
    actual = _employee_report(spark, sf_dir)
    expected = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "c_custkey AS id",
        f"concat_ws(' ', CASE WHEN c_custkey % {fixtures.EMPLOYEE_NO_FIRST_NAME_EVERY} = 0 THEN NULL "
        "ELSE c_mktsegment END, c_name) AS name",
        f"CAST(c_nationkey AS BIGINT) * {people.STEPS_PER_FLOOR} AS steps_to_desk",
    )
    return checks.reconcile(actual, expected, "steps_to_desk")


def flatten_report(spark, sf_dir):
    """FLOW-01: flat set summary by status."""
    flat = _flat(spark, sf_dir, schema=schemas.page_schema(("status", "total"), ("id",)))
    inv = F.col(flatten.INV)
    return flat.groupBy(inv["status"].alias("status")).agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.sum(F.size(inv["line_items"])).cast("bigint").alias("n_line_items"),
        F.sum(inv["total"]).alias("total_amount"))


def load_full(spark, sf_dir):
    """FLOW-02: seed, full load; the target table."""
    return read_published(spark, _full_scenario(spark, sf_dir))


def load_incremental(spark, sf_dir):
    """FLOW-03: full load of the first half, then an incremental run; the target."""
    return read_published(spark, _incremental_scenario(spark, sf_dir))


def load_replay(spark, sf_dir):
    """FLOW-03 with a crash after the write and a retry: no duplicates."""
    return read_published(spark, _incremental_scenario(spark, sf_dir, crash=True))


def stream_ingest(spark, sf_dir):
    """SRC-02 as a file stream: two landed fetches ingested exactly once.

    The second fetch lands after the first run and repeats the upper half of the
    first one's invoices; a third availableNow run must find nothing new.
    """
    def build():
        half = _half_mark(spark, sf_dir)
        base = fresh_dir(spark, "stream")
        target = f"{base}/target"
        run = lambda: ingest.ingest_available(
            spark, f"{base}/landing/*/*.json.gz", target, f"{base}/checkpoint", f"{base}/lake")
        land_pages(fixtures.report_pages(spark, sf_dir, max_order_key=half), f"{base}/landing/fetch-1")
        run()
        land_pages(fixtures.report_pages(spark, sf_dir, min_order_key=half // 2), f"{base}/landing/fetch-2")
        run()
        if run() != 0:
            raise AssertionError("a second availableNow run found files already ingested")
        return target
    target = _memo(("stream", sf_dir, id(spark.sparkContext)), build)
    return ingest.read_ingested(spark, target).drop(ingest.BATCH_COLUMN)


QUERIES: dict[str, Query] = {
    "json_page_scan": json_page_scan,
    "json_multiline_scan": json_multiline_scan,
    "explode_invoices": explode_invoices,
    "project_invoices": project_invoices,
    "project_items": project_items,
    "format_epoch_tz": format_epoch_tz,
    "delta_filter": delta_filter,
    "delta_filter_pushed": delta_filter_pushed,
    "full_load_bypass": full_load_bypass,
    "join_invoice_items": join_invoice_items,
    "join_invoice_items_nested": join_invoice_items_nested,
    "join_invoice_items_null_safe": join_invoice_items_null_safe,
    "join_invoice_items_left": join_invoice_items_left,
    "explode_items_outer": explode_items_outer,
    "max_invoice_id": max_invoice_id,
    "mean_steps": mean_steps,
    "row_count": row_count,
    "employee_report": employee_report,
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_single_file": parquet_single_file,
    "ensure_table": ensure_table,
    "inline_rows": inline_rows_query,
    "control_active_run": control_active_run,
    "control_close_open": control_close_open,
    "load_empty_delta": load_empty_delta,
    "watermark_cleanup": watermark_cleanup,
    "run_gate": run_gate,
    "preview_joined": preview_joined,
    "contract_violations": contract_violations,
    "schema_check": schema_check,
    "reconcile": reconcile,
    "flatten_report": flatten_report,
    "load_full": load_full,
    "load_incremental": load_incremental,
    "load_replay": load_replay,
    "stream_ingest": stream_ingest,
}
