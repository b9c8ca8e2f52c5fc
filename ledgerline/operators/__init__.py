"""DataFrame -> DataFrame operators."""

from ledgerline.operators.checks import contract_violations, reconcile, schema_diff, split_valid
from ledgerline.operators.flatten import (
    delta_filter, explode_invoices, explode_invoices_since, load_invoices,
    project_invoices, project_items, reject_non_numeric,
)
from ledgerline.operators.join import ids_are_unique, join_flat, join_invoice_items, join_nested
from ledgerline.operators.metrics import max_invoice_id, mean_of, preview, row_count
from ledgerline.operators.people import transform_employees

__all__ = [
    "contract_violations", "delta_filter", "explode_invoices",
    "explode_invoices_since", "ids_are_unique", "join_flat", "join_invoice_items",
    "join_nested", "load_invoices", "max_invoice_id", "mean_of", "preview",
    "project_invoices", "project_items", "reconcile", "reject_non_numeric",
    "row_count", "schema_diff", "split_valid", "transform_employees",
]
