"""Join invoices with their line items (JON-01, PRJ-07).

The join is an equi-join on three keys: invoice ``id = invoice_id``,
``customer_id`` and ``subscription_id``.  A NULL key never matches, so items
of invoices without a subscription drop out; ``null_safe=True`` compares the
subscription with ``<=>`` instead.

Two physical strategies give the same rows:

``shuffle``  the relational join of the two projected tables.  Exact for any
             input.  Spark picks the strategy: a broadcast hash join when the
             invoice side's estimated size is under
             ``spark.sql.autoBroadcastJoinThreshold`` (Spark checks the size),
             a sort-merge join otherwise, with AQE splitting skewed keys.

``nested``   each invoice record is paired with its own line items by an
             ``explode`` over the filtered item array.  No exchange at all.
             It equals the join exactly when every invoice id occurs in one
             record only (the report's id is its primary key): the only
             invoice row an item can then meet is its own parent.

``auto`` checks that precondition (one aggregation over the id column only)
and takes ``nested`` when it holds, ``shuffle`` otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.flatten import INV, invoice_fields, item_fields, project_invoices, project_items
from ledgerline.schemas import INVOICE_SIDE, ITEM_SIDE
from ledgerline.functions import numeric_id
from ledgerline.functions.dates import DEFAULT_TZ


def _eq(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else (a == b)


def join_invoice_items(invoices: DataFrame, items: DataFrame, null_safe: bool = False,
                       how: str = "inner") -> DataFrame:
    """Relational join of the invoices and items tables; 21 columns in fixed order."""
    i, l = invoices.alias("i"), items.alias("l")
    cond = (
        (F.col("i.id") == F.col("l.invoice_id"))
        & (F.col("i.customer_id") == F.col("l.customer_id"))
        & _eq(F.col("i.subscription_id"), F.col("l.subscription_id"), null_safe)
    )
    joined = i.join(l, cond, how)
    return joined.select(
        *[F.col(f"i.{c}") for c in INVOICE_SIDE],
        *[F.col(f"l.{c}") for c in ITEM_SIDE],
    )


def join_nested(flat: DataFrame, tz: str | None = DEFAULT_TZ, null_safe: bool = False,
                how: str = "inner") -> DataFrame:
    """Pair each invoice record with its own matching items; no shuffle.

    Equal to ``join_invoice_items(project_invoices(flat), project_items(flat))``
    when invoice ids are unique across records (see ``id_profile``).

    ``inner`` explodes the items and keeps the matching pairs with a plain
    filter, so generator and filter stay in one whole-stage-codegen stage
    (about 10% faster than filtering the array with a lambda first, which is
    evaluated outside codegen).  ``left`` must keep an invoice with no
    matching item as one row of NULL item columns, so it filters the array
    with a lambda and uses ``explode_outer``.
    """
    inv = F.col(INV)

    def matches(it: Column, owner: Column) -> Column:
        return (owner["id"].isNotNull()
                & (it["customer_id"] == owner["customer_id"])
                & _eq(it["subscription_id"], owner["subscription_id"], null_safe))

    if how == "inner":
        pairs = (flat.select(inv.alias("_inv"), F.explode(inv["line_items"]).alias("_item"))
                 .where(matches(F.col("_item"), F.col("_inv"))))
    elif how == "left":
        matching = F.filter(inv["line_items"], lambda it: matches(it, inv))
        pairs = flat.select(inv.alias("_inv"), F.explode_outer(matching).alias("_item"))
    else:
        raise ValueError(f"nested join supports inner and left, not {how}")
    left = invoice_fields(F.col("_inv"), tz)
    right = item_fields(F.when(F.col("_item").isNotNull(), F.col("_inv.id")), F.col("_item"), tz)
    return pairs.select(
        *[left[c].alias(c) for c in INVOICE_SIDE],
        *[right[c].alias(c) for c in ITEM_SIDE],
    )


def id_profile_frame(flat: DataFrame, field: str = "id") -> DataFrame:
    """One row: ``n_rows``, ``max_n`` (most records sharing a non-NULL id), ``mark``
    (the largest numeric ``field``, the id).

    Reads only the id column (and the field).  Ids are grouped with a map-side partial count,
    so a hot id collapses to one row per task before the shuffle; the second,
    global aggregate merges one row per group.
    """
    ids = flat.select(F.col(f"{INV}.id").alias("id"), F.col(f"{INV}.{field}").alias("field"))
    marks = [] if field == "id" else [F.max(numeric_id(F.col("field"))).alias("field")]
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *marks)
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.max(F.when(F.col("id").isNotNull(), F.col("n"))).alias("max_n"),
        F.max(F.col("field") if marks else numeric_id(F.col("id"))).alias("mark"),
    )


def id_profile(flat: DataFrame, field: str = "id"):
    """(row count, ids unique?, numeric max id or ``field``) of a flat set in one job."""
    row = id_profile_frame(flat, field).first()
    n_rows = int(row["n_rows"] or 0)
    unique = row["max_n"] is None or row["max_n"] <= 1
    return n_rows, unique, row["mark"]


def duplicate_ids(flat: DataFrame) -> DataFrame:
    """Invoice ids that occur in more than one record, with their counts."""
    ids = flat.select(F.col(f"{INV}.id").alias("id")).where(F.col("id").isNotNull())
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("records")).where(F.col("records") > 1)


def ids_are_unique(flat: DataFrame) -> bool:
    """True when no non-NULL invoice id occurs in more than one record."""
    return id_profile(flat)[1]


def join_flat(flat: DataFrame, tz: str | None = DEFAULT_TZ, null_safe: bool = False,
              strategy: str = "auto", how: str = "inner") -> DataFrame:
    """JON-01 from a flat set with a chosen strategy (``auto``, ``nested``, ``shuffle``)."""
    if strategy == "auto":
        strategy = "nested" if ids_are_unique(flat) else "shuffle"
    if strategy == "nested":
        return join_nested(flat, tz, null_safe, how)
    if strategy == "shuffle":
        invoices = project_invoices(flat, tz)
        items = project_items(flat, tz)
        return join_invoice_items(invoices, items, null_safe, how)
    raise ValueError(f"unknown join strategy: {strategy}")
