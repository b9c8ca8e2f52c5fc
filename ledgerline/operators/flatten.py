"""Flatten report pages into invoices and line items.

Covers PRJ-01..06, FLT-01, FLT-02 and FLOW-01.  All functions are
DataFrame -> DataFrame and lazy; they compose with ``df.transform``.

The flat set keeps every sibling column of ``list`` (e.g. ``page_no``) and
one struct column ``flat_invoice`` per invoice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import bool_text, format_epoch, numeric_id
from ledgerline.functions.dates import DEFAULT_TZ

INV = "flat_invoice.invoice"


def explode_invoices(pages: DataFrame, outer: bool = False) -> DataFrame:
    """One row per invoice; sibling columns stay (PRJ-02, PRJ-03).

    A page with an empty or NULL ``list`` yields no row, unless ``outer``.
    """
    gen = F.explode_outer if outer else F.explode
    return pages.withColumn("flat_invoice", gen(F.col("list"))).drop("list")


def _mark_active(mark) -> bool:
    return mark is not None and mark > 0


def delta_filter(flat: DataFrame, mark, field: str = "id") -> DataFrame:
    """Keep invoices whose numeric ``field`` (the id) is strictly greater than ``mark`` (FLT-01).

    FLT-02: a NULL, zero or negative mark means a full load, no filter.
    Non-numeric values never pass a delta filter (see ``reject_non_numeric``).
    """
    if not _mark_active(mark):
        return flat
    return flat.where(numeric_id(F.col(f"{INV}.{field}")) > F.lit(mark))


def explode_invoices_since(pages: DataFrame, mark, outer: bool = False, field: str = "id") -> DataFrame:
    """Explode with the delta filter applied to the array first.

    Catalyst does not push a filter on the exploded struct below the
    ``Generate``; filtering the array with a higher-order function means the
    rows older than the mark are never produced at all.  Same rows as
    ``delta_filter(explode_invoices(pages, outer), mark)``: with an active mark
    the NULL rows of an outer explode never pass the filter, so ``outer``
    only matters for a full load.
    """
    if not _mark_active(mark):
        return explode_invoices(pages, outer)
    kept = F.filter(F.col("list"), lambda x: numeric_id(x["invoice"][field]) > F.lit(mark))
    return pages.withColumn("flat_invoice", F.explode(kept)).drop("list")


def reject_non_numeric(flat: DataFrame, field: str = "id") -> DataFrame:
    """Invoices whose ``field`` (the id) is no integer, or NULL: they are left out of every delta."""
    return flat.where(numeric_id(F.col(f"{INV}.{field}")).isNull())


def invoice_fields(inv: Column, tz: str | None = DEFAULT_TZ) -> dict[str, Column]:
    """The 12 invoice output columns, by name, from an ``invoice`` struct (PRJ-01, PRJ-05)."""
    return {
        "id": inv["id"],
        "invoice_date": format_epoch(inv["date"], tz),
        "invoice_due_date": format_epoch(inv["due_date"], tz),
        "total": inv["total"],
        "amount_paid": inv["amount_paid"],
        "amount_due": inv["amount_due"],
        "invoice_paid_date": format_epoch(inv["paid_at"], tz),
        "tax": inv["tax"],
        "customer_id": inv["customer_id"],
        "subscription_id": inv["subscription_id"],
        "status": inv["status"],
        "currency_code": inv["currency_code"],
    }


def item_fields(invoice_id: Column, item: Column, tz: str | None = DEFAULT_TZ) -> dict[str, Column]:
    """The 12 line-item output columns, by name (PRJ-06, TYP-01)."""
    return {
        "invoice_id": invoice_id,
        "amount": item["amount"],
        "date_from": format_epoch(item["date_from"], tz),
        "date_to": format_epoch(item["date_to"], tz),
        "discount_amount": item["discount_amount"],
        "item_level_discount_amount": item["item_level_discount_amount"],
        "customer_id": item["customer_id"],
        "subscription_id": item["subscription_id"],
        "id": item["id"],
        "quantity": item["quantity"],
        "unit_amount": item["unit_amount"],
        "is_taxed_item": bool_text(item["is_taxed"]),
    }


def _aliased(fields: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in fields.items()]


def project_invoices(flat: DataFrame, tz: str | None = DEFAULT_TZ) -> DataFrame:
    """Invoices table, 12 columns with three formatted dates."""
    return flat.select(*_aliased(invoice_fields(F.col(INV), tz)))


def project_items(flat: DataFrame, tz: str | None = DEFAULT_TZ, outer: bool = False) -> DataFrame:
    """Line-items table, carrying the parent invoice id (PRJ-04).

    Invoices without items vanish unless ``outer``, which keeps one row with
    NULL item fields for each of them.
    """
    gen = F.explode_outer if outer else F.explode
    exploded = flat.select(
        F.col(f"{INV}.id").alias("invoice_id"),
        gen(F.col(f"{INV}.line_items")).alias("flat_items"),
    )
    return exploded.select(*_aliased(item_fields(F.col("invoice_id"), F.col("flat_items"), tz)))


def load_invoices(pages: DataFrame, mark=None, tz: str | None = DEFAULT_TZ,
                  filter_first: bool = True):
    """FLOW-01: pages -> (flat set, invoices, items), delta-filtered by ``mark``."""
    if filter_first:
        flat = explode_invoices_since(pages, mark)
    else:
        flat = delta_filter(explode_invoices(pages), mark)
    return flat, project_invoices(flat, tz), project_items(flat, tz)
