"""JDBC sinks (SNK-01, SNK-02).

``overwrite`` uses ``truncate=true`` so the table keeps its definition (a
plain overwrite drops and recreates it from the DataFrame's schema).
``append_new_rows`` adds the rows that the target doesn't hold yet as often as
they occur, so a retried run completes an insert that stopped half-way and adds
nothing to a finished one.  Only the target's rows in a given scope are read
(the predicate is pushed to the database).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _options(url: str, table: str, driver: str | None, extra: dict | None) -> dict:
    opts = {"url": url, "dbtable": table}
    if driver:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str | None = None,
              options: dict | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**_options(url, table, driver, options)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, driver: str | None = None,
               options: dict | None = None) -> None:
    """Bulk write: ``overwrite`` (truncating) or ``append``."""
    opts = _options(url, table, driver, options)
    if mode == "overwrite":
        opts.setdefault("truncate", "true")
    df.write.format("jdbc").options(**opts).mode(mode).save()


def table_exists(spark: SparkSession, url: str, table: str, driver: str | None = None,
                 options: dict | None = None) -> bool:
    """Whether the target table exists (resolving its schema reads no rows)."""
    try:
        read_jdbc(spark, url, table, driver, options).schema
        return True
    except Exception as exc:  # the driver's "no such table" error, wrapped by Spark
        text = str(exc).lower()
        if "does not exist" in text or "not found" in text or "no such table" in text:
            return False
        raise


def append_new_rows(spark: SparkSession, df: DataFrame, url: str, table: str,
                    driver: str | None = None, options: dict | None = None,
                    scope: Column | None = None) -> None:
    """Append the rows of ``df`` that the target does not hold yet (replay-safe).

    The difference is one of bags over whole rows: of a row that ``df`` holds
    three times and the target once, two are added, and NULLs count as equal.
    Only the rows matching ``scope`` (e.g. ``run_id = 7``) are read: Spark pushes a
    simple predicate into the database query, so a retried run reads its own
    earlier rows, not the whole table.  A missing table is created by the append.
    ``options`` go to reads and writes alike (``numPartitions`` bounds the
    connections; with ``partitionColumn``, ``lowerBound`` and ``upperBound`` the
    read is split too).
    """
    if table_exists(spark, url, table, driver, options):
        existing = read_jdbc(spark, url, table, driver, options)
        if scope is not None:
            existing = existing.where(scope)
        df = df.exceptAll(existing.select(*(F.col(f.name).cast(f.dataType) for f in df.schema.fields)))
    write_jdbc(df, url, table, "append", driver, options)
