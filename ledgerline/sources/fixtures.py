"""Nested report pages derived from the driver's tables.

The reference reads a billing report fetched from an API: pages whose ``list``
holds invoices, each with its ``line_items``.  No such file ships with it, so
the pages are derived from ``orders`` (invoices), ``lineitem`` (line items)
and ``customer`` (the employee stand-in) by fixed rules that the DuckDB
oracles repeat in SQL.

Plan shape.  A page holds at most ``page_size`` invoices (``o_orderkey div
page_size``), so no page grows with the data.  Each input table is shuffled
exactly once, on the page number, as the few columns that the report's fields are
derived from; the fields themselves are derived behind the shuffle:

* ``lineitem`` is hash-partitioned on the page, then grouped by
  (page, order) and by page without another exchange (a hash partitioning on
  the page satisfies both groupings), giving one map order -> items per page;
* ``orders`` is hash-partitioned and grouped by page;
* the two page-level results join on the page with no further exchange
  (same partitioning on both sides), and each invoice picks its items from
  the page's map.

Item arrays are grouped per order.  The largest order in the driver data
has 13 items at sf0.01 and 17 at sf0.1 (mean 4.1), so a group holds a
handful of rows however large the tables grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

# Fixed values of the derivation (repeated in the oracle SQL).
PAGE_SIZE = 100                 # invoices per report page
NO_SUBSCRIPTION_EVERY = 17      # order keys divisible by this have no subscription
SUBSCRIPTIONS_PER_CUSTOMER = 100
DUE_DAYS = 30
PAID_AFTER_DAYS = 10
ITEM_PERIOD_DAYS = 30
MISMATCH_LINE = 7               # items on this line number carry customer 'c-1'
MISMATCH_CUSTOMER = "c-1"
CURRENCY = "EUR"
STATUS_TEXT = {"F": "paid", "O": "payment_due", "P": "posted"}
EMPLOYEE_NO_FIRST_NAME_EVERY = 7
DAY = 86400

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _epoch(df: DataFrame, ts: str) -> Column:
    """Epoch seconds of a timestamp column, independent of the session zone.

    A TIMESTAMP_NTZ (the driver tables) counts seconds from the NTZ epoch; a
    TIMESTAMP (an instant) uses ``unix_seconds``; a DATE is midnight UTC.
    """
    dtype = df.schema[ts].dataType
    if isinstance(dtype, TimestampType):
        return F.unix_seconds(F.col(ts))
    if isinstance(dtype, DateType):
        return F.unix_date(F.col(ts)).cast("bigint") * DAY
    return F.expr(f"timestampdiff(SECOND, {_EPOCH_NTZ}, {ts})")


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _status_text(c: Column) -> Column:
    expr = None
    for code, text in STATUS_TEXT.items():
        expr = F.when(c == code, text) if expr is None else expr.when(c == code, text)
    return expr


def _key_range(df: DataFrame, key: str, min_key, max_key) -> DataFrame:
    if min_key is not None:
        df = df.where(F.col(key) >= min_key)
    if max_key is not None:
        df = df.where(F.col(key) <= max_key)
    return df


def invoice_rows(spark: SparkSession, sf_dir: str, max_order_key: int | None = None,
                 min_order_key: int | None = None) -> DataFrame:
    """What an invoice is derived from, one narrow row per order: this is what crosses the shuffle."""
    o = _key_range(_table(spark, sf_dir, "orders"), "o_orderkey", min_order_key, max_order_key)
    return o.select(
        F.col("o_orderkey"),
        F.expr(f"o_orderkey div {PAGE_SIZE}").alias("page_no"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        _epoch(o, "o_orderdate").alias("date"),
        _cents(F.col("o_totalprice")).alias("total"),
    )


def item_rows(spark: SparkSession, sf_dir: str, max_order_key: int | None = None,
              min_order_key: int | None = None) -> DataFrame:
    """What a line item is derived from, one narrow row per item."""
    li = _key_range(_table(spark, sf_dir, "lineitem"), "l_orderkey", min_order_key, max_order_key)
    return li.select(
        F.col("l_orderkey"),
        F.expr(f"l_orderkey div {PAGE_SIZE}").alias("page_no"),
        F.col("l_linenumber"),
        _epoch(li, "l_shipdate").alias("date_from"),
        _cents(F.col("l_extendedprice")).alias("amount"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _cents(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        (F.col("l_tax") > 0).alias("is_taxed"),
    )


def _invoice_fields() -> dict[str, Column]:
    """The fields of an invoice, without its items, from a row of ``invoice_rows``."""
    paid = F.col("o_orderstatus") == "F"
    zero = F.lit(0).cast("bigint")
    return {
        "id": F.col("o_orderkey").cast("string"),
        "customer_id": F.concat(F.lit("c"), F.col("o_custkey").cast("string")),
        "subscription_id": F.when(F.col("o_orderkey") % NO_SUBSCRIPTION_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("s"), (F.col("o_custkey") % SUBSCRIPTIONS_PER_CUSTOMER).cast("string"))),
        "status": _status_text(F.col("o_orderstatus")),
        "currency_code": F.lit(CURRENCY),
        "date": F.col("date"),
        "due_date": F.col("date") + DUE_DAYS * DAY,
        "paid_at": F.when(paid, F.col("date") + PAID_AFTER_DAYS * DAY),
        "total": F.col("total"),
        "amount_paid": F.when(paid, F.col("total")).otherwise(zero),
        "amount_due": F.when(paid, zero).otherwise(F.col("total")),
        "tax": F.expr("total div 10"),
    }


def report_pages(spark: SparkSession, sf_dir: str, max_order_key: int | None = None,
                 min_order_key: int | None = None) -> DataFrame:
    """Report pages (schema ``schemas.PAGE``) for the orders in a key range."""
    items = item_rows(spark, sf_dir, max_order_key, min_order_key)
    item_struct = F.struct("l_linenumber", "date_from", "amount", "quantity", "discount_amount", "is_taxed")
    items_by_page = (
        items.repartition("page_no")
        .groupBy("page_no", "l_orderkey")
        .agg(F.sort_array(F.collect_list(item_struct)).alias("items"))
        .groupBy("page_no")
        .agg(F.map_from_entries(F.collect_list(F.struct("l_orderkey", "items"))).alias("items_by_order"))
    )

    inv = invoice_rows(spark, sf_dir, max_order_key, min_order_key).repartition("page_no")
    fields = _invoice_fields()
    inv_struct = F.struct("o_orderkey", *[c.alias(name) for name, c in fields.items()])
    invoices_by_page = inv.groupBy("page_no").agg(F.sort_array(F.collect_list(inv_struct)).alias("invoices"))

    def nest(o):
        own_items = F.coalesce(F.try_element_at(F.col("items_by_order"), o["o_orderkey"]), F.array())

        def item(i):
            return F.struct(
                F.concat(o["id"], F.lit("-"), i["l_linenumber"].cast("string")).alias("id"),
                F.when(i["l_linenumber"] == MISMATCH_LINE, F.lit(MISMATCH_CUSTOMER))
                .otherwise(o["customer_id"]).alias("customer_id"),
                o["subscription_id"].alias("subscription_id"),
                i["date_from"].alias("date_from"),
                (i["date_from"] + ITEM_PERIOD_DAYS * DAY).alias("date_to"),
                i["amount"].alias("amount"),
                F.call_function("div", i["amount"], i["quantity"]).alias("unit_amount"),
                i["quantity"].alias("quantity"),
                i["discount_amount"].alias("discount_amount"),
                F.lit(0).cast("bigint").alias("item_level_discount_amount"),
                i["is_taxed"].alias("is_taxed"),
            )

        return F.struct(F.struct(
            *[o[name].alias(name) for name in fields],
            F.transform(own_items, item).alias("line_items"),
        ).alias("invoice"))

    pages = invoices_by_page.join(items_by_page, "page_no", "left")
    return pages.select(
        F.col("page_no"),
        F.lit(None).cast("string").alias("next_offset"),
        F.transform(F.col("invoices"), nest).alias("list"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee stand-in from ``customer`` (schema ``schemas.EMPLOYEES``)."""
    c = _table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % EMPLOYEE_NO_FIRST_NAME_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("first_name"),
        F.col("c_name").alias("second_name"),
        F.col("c_nationkey").cast("bigint").alias("floor"),
    )
