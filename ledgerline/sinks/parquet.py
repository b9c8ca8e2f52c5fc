"""Parquet sinks (SNK-03, SNK-04, SNK-05).

A run writes to folders of its own attempt (``run_id=N/attempt=<id>``), which nothing
else ever writes to.  The control table names the attempt whose run was published, so a
retried, racing or failed attempt can neither replace published rows nor add to them.
``write_run_partition`` is the plain form for a caller that is the only writer
of its run: it replaces the run's folder.

A table keeps its definition beside its data: column names, types, NOT NULL and
partitioning, in a file whose exclusive creation decides between racing creators.
``insert_into`` and ``conform_to`` refuse rows of another definition.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline.session import create_exclusive, list_children, path_exists, read_small

RUN_COLUMN = "run_id"
ATTEMPT_COLUMN = "attempt"
COMPRESSION = "zstd"                   # of runs, attempts and flat sets
DEFINITION = "_definition.json"        # Spark's readers skip names with an underscore


def with_run_column(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(RUN_COLUMN, LongType(), True)])


# ------------------------------------------------------------------ one folder per run

def write_run_partition(df: DataFrame, path: str, run_id: int) -> None:
    """Write ``df`` as the partition ``run_id`` of a table partitioned by run,
    in place of what an earlier attempt of this run may have left."""
    (df.drop(RUN_COLUMN).write.mode("overwrite").option("compression", COMPRESSION)
        .parquet(f"{path}/{RUN_COLUMN}={run_id}"))


def read_run_partition(spark: SparkSession, path: str, schema: StructType, run_id: int) -> DataFrame:
    """One run's partition; the ``run_id`` filter prunes all other partitions."""
    full = spark.read.schema(with_run_column(schema)).parquet(path)
    return full.where(F.col(RUN_COLUMN) == F.lit(run_id)).drop(RUN_COLUMN)


# -------------------------------------------------------------- one folder per attempt

def attempt_folder(path: str, run_id: int, attempt: str) -> str:
    return f"{path.rstrip('/')}/{RUN_COLUMN}={run_id}/{ATTEMPT_COLUMN}={attempt}"


def write_attempt(df: DataFrame, path: str, run_id: int, attempt: str) -> None:
    """Write the rows of one attempt of a run; its folder must not exist yet."""
    (df.drop(RUN_COLUMN, ATTEMPT_COLUMN).write.mode("errorifexists").option("compression", COMPRESSION)
        .parquet(attempt_folder(path, run_id, attempt)))


def read_attempt(spark: SparkSession, path: str, schema: StructType, run_id: int, attempt: str) -> DataFrame:
    return spark.read.schema(schema).parquet(attempt_folder(path, run_id, attempt))


def read_attempts(spark: SparkSession, path: str, schema: StructType, attempts) -> DataFrame:
    """The rows of the given (run id, attempt) pairs with their ``run_id``; only their
    folders are listed and read.  Without an attempt the run's own folder is meant."""
    path, parts = path.rstrip("/"), []
    named = [attempt_folder(path, r, a) for r, a in attempts if a]
    plain = [f"{path}/{RUN_COLUMN}={r}" for r, a in attempts if not a]
    full = with_run_column(schema)
    if named:
        deep = StructType(list(full.fields) + [StructField(ATTEMPT_COLUMN, StringType())])
        parts.append(spark.read.schema(deep).option("basePath", path).parquet(*named).drop(ATTEMPT_COLUMN))
    if plain:
        parts.append(spark.read.schema(full).option("basePath", path).parquet(*plain))
    if not parts:
        return spark.createDataFrame([], full)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# ------------------------------------------------------------------------------- files

def write_files(df: DataFrame, path: str, n_files: int | None = None) -> None:
    """Overwrite ``path``, in parallel (SNK-04).

    ``n_files`` asks for at most that many files: that many tasks then carry
    all rows, which suits fixtures and small reports, whatever their size.
    """
    (df.coalesce(n_files) if n_files else df).write.mode("overwrite").parquet(path)


# ----------------------------------------------------------------------- defined tables

class DefinitionMismatch(ValueError):
    """Rows don't have the columns or types of the table they are written to."""


@dataclass(frozen=True)
class Definition:
    schema: StructType                              # all columns, partition columns too
    partition_by: tuple[str, ...] = ()
    properties: dict = field(default_factory=dict)  # for the caller's use


def define_table(spark: SparkSession, path: str, schema: StructType, partition_by: list[str] | None = None,
                 properties: dict | None = None) -> bool:
    """Store a definition unless there is one; of racing callers one creates it."""
    body = {"schema": json.loads(schema.json()), "partition_by": list(partition_by or ()), "properties": properties or {}}
    if path_exists(spark, f"{path.rstrip('/')}/{DEFINITION}"):
        return False
    try:
        create_exclusive(spark, f"{path.rstrip('/')}/{DEFINITION}", json.dumps(body))
    except FileExistsError:
        return False
    return True


def table_definition(spark: SparkSession, path: str) -> Definition | None:
    """The stored definition, None for a folder without one."""
    name = f"{path.rstrip('/')}/{DEFINITION}"
    if not path_exists(spark, name):
        return None
    body = json.loads(read_small(spark, name))
    return Definition(StructType.fromJson(body["schema"]), tuple(body["partition_by"]), body["properties"])


def ensure_table(spark: SparkSession, path: str, schema: StructType,
                 partition_by: list[str] | None = None, properties: dict | None = None) -> bool:
    """Create an empty table with a fixed schema unless one exists (SNK-05).

    Returns True when the table was created.  A folder that holds anything is left as it
    is.  The definition is stored with the table; ``insert_into`` holds later writes to it.
    """
    if list_children(spark, path):
        return False                                    # never touches files that are there
    if not define_table(spark, path, schema, partition_by, properties):
        return False
    if not partition_by:                                # an empty partitioned write makes no file
        spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    return True


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df``'s columns by name into ``schema``'s order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def check_columns(given: StructType, schema: StructType, table: str = "the table") -> None:
    """Refuse another set of columns, or another type, than defined."""
    types = {f.name: f.dataType for f in given.fields}
    wrong = [f"{f.name}: {f.dataType.simpleString()} is defined, {types[f.name].simpleString()} given"
             if f.name in types else f"{f.name}: missing"
             for f in schema.fields if types.get(f.name) != f.dataType]
    wrong += [f"{name}: not defined" for name in types if name not in schema.fieldNames()]
    if wrong:
        raise DefinitionMismatch(f"{table}: " + "; ".join(wrong))


def conform_to(df: DataFrame, schema: StructType, table: str = "the table") -> DataFrame:
    """``df`` in the order of a definition, held to it.

    Other columns or types are refused here; a NULL in a NOT NULL column
    fails the task that meets it, so the write ends without a single row being committed.
    """
    check_columns(df.schema, schema, table)

    def held(f: StructField):
        c = F.col(f.name)
        if f.nullable:
            return c
        said = F.raise_error(F.lit(f"NULL in NOT NULL column {f.name} of {table}"))
        return F.when(c.isNull(), said).otherwise(c).alias(f.name)

    return df.select(*[held(f) for f in schema.fields])


def insert_into(df: DataFrame, path: str) -> None:
    """Append ``df`` to a table made by ``ensure_table``, by column name, held to its definition."""
    definition = table_definition(df.sparkSession, path)
    if definition is None:
        raise DefinitionMismatch(f"{path} has no definition")
    writer = conform_to(df, definition.schema, path).write.mode("append")
    if definition.partition_by:
        writer = writer.partitionBy(*definition.partition_by)
    writer.parquet(path)
