"""Declared schemas for every table the library reads or writes.

The report is always read with an explicit schema: inference costs a full
extra pass over the input, types an empty ``list`` as ``array<string>`` and
fails analysis when a field is absent from a whole file.  With a declared
schema an absent field simply reads as NULL.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _f(name, dtype, nullable=True):
    return StructField(name, dtype, nullable)


# One line item inside an invoice (amounts are integer minor units).
LINE_ITEM = StructType([
    _f("id", StringType()),
    _f("customer_id", StringType()),
    _f("subscription_id", StringType()),
    _f("date_from", LongType()),
    _f("date_to", LongType()),
    _f("amount", LongType()),
    _f("unit_amount", LongType()),
    _f("quantity", LongType()),
    _f("discount_amount", LongType()),
    _f("item_level_discount_amount", LongType()),
    _f("is_taxed", BooleanType()),
])

# One invoice; dates are epoch seconds.
INVOICE = StructType([
    _f("id", StringType()),
    _f("customer_id", StringType()),
    _f("subscription_id", StringType()),
    _f("status", StringType()),
    _f("currency_code", StringType()),
    _f("date", LongType()),
    _f("due_date", LongType()),
    _f("paid_at", LongType()),
    _f("total", LongType()),
    _f("amount_paid", LongType()),
    _f("amount_due", LongType()),
    _f("tax", LongType()),
    _f("line_items", ArrayType(LINE_ITEM)),
])

# One report page: sibling columns plus ``list`` of ``{"invoice": {...}}``.
PAGE = StructType([
    _f("page_no", LongType()),
    _f("next_offset", StringType()),
    _f("list", ArrayType(StructType([_f("invoice", INVOICE)]))),
])

# Flattened set: sibling columns plus one ``flat_invoice`` struct per invoice.
FLAT = StructType([
    _f("page_no", LongType()),
    _f("next_offset", StringType()),
    _f("flat_invoice", StructType([_f("invoice", INVOICE)])),
])

def page_schema(invoice_fields=None, item_fields=None) -> StructType:
    """A page schema keeping only the named invoice and line-item fields.

    Catalyst prunes nested fields of Parquet scans but not of JSON scans, so
    a reader that needs a few fields passes this narrower schema itself: the
    JSON parser skips every field it is not asked for instead of building
    it.  ``None`` keeps all fields; ``item_fields=()`` drops ``line_items``.
    """
    items = [f for f in LINE_ITEM.fields if item_fields is None or f.name in item_fields]
    inv = []
    for f in INVOICE.fields:
        if f.name == "line_items":
            if item_fields is None or item_fields:
                inv.append(_f("line_items", ArrayType(StructType(items))))
        elif invoice_fields is None or f.name in invoice_fields:
            inv.append(f)
    return StructType([
        _f("page_no", LongType()),
        _f("next_offset", StringType()),
        _f("list", ArrayType(StructType([_f("invoice", StructType(inv))]))),
    ])


# Page schema without line items: an invoice-only read never builds the item arrays.
PAGE_HEADERS_ONLY = page_schema(item_fields=())

# The column names and orders of the three tables below.
# Flattened invoices (12 columns, in output order).
INVOICES = StructType([
    _f("id", StringType()),
    _f("invoice_date", StringType()),
    _f("invoice_due_date", StringType()),
    _f("total", LongType()),
    _f("amount_paid", LongType()),
    _f("amount_due", LongType()),
    _f("invoice_paid_date", StringType()),
    _f("tax", LongType()),
    _f("customer_id", StringType()),
    _f("subscription_id", StringType()),
    _f("status", StringType()),
    _f("currency_code", StringType()),
])

# Flattened line items (12 columns, in output order).
ITEMS = StructType([
    _f("invoice_id", StringType()),
    _f("amount", LongType()),
    _f("date_from", StringType()),
    _f("date_to", StringType()),
    _f("discount_amount", LongType()),
    _f("item_level_discount_amount", LongType()),
    _f("customer_id", StringType()),
    _f("subscription_id", StringType()),
    _f("id", StringType()),
    _f("quantity", LongType()),
    _f("unit_amount", LongType()),
    _f("is_taxed_item", StringType()),
])

# Joined target (21 columns, in output order).
INVOICE_DATA_COLUMNS = [
    "invoice_date", "invoice_due_date", "total", "amount_paid", "amount_due",
    "invoice_paid_date", "tax", "customer_id", "subscription_id", "status",
    "currency_code", "invoice_id", "amount", "date_from", "date_to",
    "discount_amount", "item_level_discount_amount", "id", "quantity",
    "unit_amount", "is_taxed_item",
]

# Which side of the join each output column comes from.
INVOICE_SIDE = INVOICE_DATA_COLUMNS[:11]
ITEM_SIDE = INVOICE_DATA_COLUMNS[11:]

_TYPES = {f.name: f.dataType for f in INVOICES.fields}
_TYPES.update({f.name: f.dataType for f in ITEMS.fields if f.name not in INVOICE_SIDE})

# Target table in the fixed DDL column order; NOT NULL columns per the DDL.
INVOICE_DATA_NOT_NULL = [
    "invoice_date", "invoice_due_date", "customer_id", "id", "date_from", "date_to",
]
INVOICE_DATA_DDL_ORDER = [
    "invoice_id", "invoice_date", "invoice_due_date", "total", "amount_paid",
    "amount_due", "invoice_paid_date", "tax", "customer_id", "subscription_id",
    "status", "currency_code", "id", "date_from", "date_to", "discount_amount",
    "amount", "item_level_discount_amount", "quantity", "unit_amount",
    "is_taxed_item",
]
INVOICE_DATA = StructType([_f(c, _TYPES[c]) for c in INVOICE_DATA_COLUMNS])
INVOICE_DATA_DDL = StructType([_f(c, _TYPES[c]) for c in INVOICE_DATA_DDL_ORDER])

# The same with its NOT NULL columns: the definition that is stored beside the target.
INVOICE_DATA_TABLE = StructType([_f(c, _TYPES[c], c not in INVOICE_DATA_NOT_NULL) for c in INVOICE_DATA_DDL_ORDER])

# Invoices that a delta can't compare with its mark, each once: key (digest of id and
# content) and whether a load has taken it (then only the key is kept).
REJECTS = StructType(list(FLAT.fields) + [_f("digest", StringType()), _f("loaded", BooleanType())])

# Run-history control table.
HISTORY = StructType([
    _f("id", LongType(), False),
    _f("etl_name", StringType(), False),
    _f("skip_execution", StringType(), False),
    _f("is_active", StringType(), False),
    _f("full_load", StringType(), False),
    _f("run_date", TimestampType()),
    _f("filter_col1_name", StringType()),
    _f("filter_col1_value", StringType()),
    _f("filter_col2_name", StringType()),
    _f("filter_col2_value", StringType()),
])

# As it is stored, with two columns of ours: the attempt whose folders hold the rows
# of a closed run, and the fetches that the run has read.
HISTORY_TABLE = StructType(list(HISTORY.fields) + [
    _f("attempt", StringType()),
    _f("fetches", ArrayType(StringType())),
])

# Employee transform input and output.
EMPLOYEES = StructType([
    _f("id", LongType()),
    _f("first_name", StringType()),
    _f("second_name", StringType()),
    _f("floor", LongType()),
])
EMPLOYEES_REPORT = StructType([
    _f("id", LongType()),
    _f("name", StringType(), False),
    _f("steps_to_desk", LongType()),
])
