"""The employee transform (FLOW-04, STR-01, MTH-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import join_names, times

# Fixed value: steps per floor used by the reference's test.
STEPS_PER_FLOOR = 21


def transform_employees(df: DataFrame, steps_per_floor: int = STEPS_PER_FLOOR) -> DataFrame:
    """``id``, full ``name`` (NULL parts skipped), ``steps_to_desk = floor * n``."""
    return df.select(
        F.col("id"),
        join_names("first_name", "second_name").alias("name"),
        times("floor", steps_per_floor).alias("steps_to_desk"),
    )
