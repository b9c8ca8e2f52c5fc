"""Global aggregates and previews (AGG-01..03, LIM-02).

Every aggregate here is global: Spark computes a partial aggregate per task
and merges the partials in one final task, so only one row per task crosses
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import numeric_id


def max_invoice_id(invoices: DataFrame, column: str = "id") -> DataFrame:
    """High-water mark as a one-row DataFrame (AGG-01).

    ``max_invoice_id`` is the numeric max (the stored mark);
    ``max_invoice_id_text`` is the string max the reference computed, kept so
    the difference stays visible ('9999' beats '14999' as text).
    """
    return invoices.agg(
        F.max(numeric_id(F.col(column))).alias("max_invoice_id"),
        F.max(F.col(column)).alias("max_invoice_id_text"),
    )


def mean_of(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Global mean of one column (AGG-02)."""
    return df.agg(F.mean(F.col(column)).alias(alias or f"avg_{column}"))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """Row count as a one-row DataFrame (AGG-03)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order (LIM-02).

    Ordered by all columns unless given, so the preview is deterministic;
    Spark plans it as a per-task top-n and a final merge of ``n`` rows per
    task (TakeOrderedAndProject), never a full sort.
    """
    cols = order_by or df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)
