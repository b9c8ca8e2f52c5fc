"""Parquet and in-memory sources (SRC-03, SRC-04)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; filters and column selections reach the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def inline_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small, fixed table given in code (lookup tables, seed rows).

    Only for data whose size is fixed by the code itself; it travels from the
    driver to the executors in the plan.
    """
    return spark.createDataFrame(list(rows), schema)
