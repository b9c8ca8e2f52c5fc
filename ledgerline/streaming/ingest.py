"""Incremental ingest of landed report pages with Structured Streaming.

The reference's incremental load remembers the largest invoice id it has
seen and filters on it next time.  When the fetches land as new files (each
fetch returns new invoices), Spark's file source already tracks which files
were processed in its checkpoint, so each landed page is read exactly once,
whatever its ids look like (late, lower or non-numeric ids are not lost).

``trigger(availableNow=True)`` processes everything landed so far and stops,
so the same code runs as a scheduled batch job or continuously.  Each
micro-batch is flattened like a batch run and written to the lake, partition
``batch_id``; a replayed batch keeps a finished lake partition and
replaces its own target partition, which makes both writes idempotent.

A fetch may repeat invoices of an earlier one.  A batch leaves out the rows whose
(invoice_id, id) an earlier batch has stored: the first stored row stays.  Rows
without one of the two ids can't be told apart and are all kept.  Which keys are new is
kept as streaming state: a second query follows the lake and drops the keys it has
met before (``dropDuplicates`` on RocksDB), one lake partition a batch.  So a
batch reads its own lake partition, and looks up and adds its own keys; neither the target nor
earlier keys are read, however long the history is.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline import schemas
from ledgerline.functions.dates import DEFAULT_TZ
from ledgerline.operators.flatten import INV, explode_invoices, project_invoices, project_items
from ledgerline.operators.join import id_profile, join_flat, join_invoice_items
from ledgerline.session import path_exists
from ledgerline.sinks.parquet import COMPRESSION, RUN_COLUMN, conform, read_run_partition, with_run_column, write_run_partition

BATCH_COLUMN = "batch_id"
ROW_KEY = ["invoice_id", "id"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_stream(spark: SparkSession, landing_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of landed page files (explicit schema, no inference)."""
    reader = spark.readStream.schema(schemas.PAGE).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(landing_glob)


@contextmanager
def _keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (on disk, looked up by key)."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def row_keys(flat: DataFrame) -> DataFrame:
    """(invoice_id, id) of the line items of a flat set, where both are there."""
    items = flat.select(F.col(f"{INV}.id").alias("invoice_id"), F.explode(F.col(f"{INV}.line_items.id")).alias("id"))
    return items.where("invoice_id IS NOT NULL AND id IS NOT NULL")


def only_new(flat: DataFrame, new_keys: DataFrame) -> DataFrame:
    """The flat set with the line items whose key is new, and those without a whole key
    (``new_keys`` holds each once).

    An invoice crosses the shuffle once, nested and unformatted, and not as one row of 21
    text columns per item; an item is looked up among the new ones of its own invoice.
    """
    per_invoice = (new_keys.groupBy(F.col("invoice_id").alias("__of"))
                   .agg(F.collect_list("id").alias("__new")))
    marked = flat.join(per_invoice, F.col(f"{INV}.id") == F.col("__of"), "left")
    kept = F.filter(F.col(f"{INV}.line_items"), lambda it: F.col(f"{INV}.id").isNull() | it["id"].isNull()
                    | F.coalesce(F.array_contains(F.col("__new"), it["id"]), F.lit(False)))
    return marked.withColumn("flat_invoice", F.col("flat_invoice").withField("invoice.line_items", kept)).select(*flat.columns)


def ingest_available(spark: SparkSession, landing_glob: str, target_path: str, checkpoint_path: str,
                     lake_path: str, tz: str | None = DEFAULT_TZ, null_safe: bool = False,
                     join_strategy: str = "auto", on_duplicate_ids: str = "fail",
                     max_files_per_trigger: int | None = None, progress: list | None = None) -> int:
    """Process every page landed so far; returns the number of micro-batches written.

    Each micro-batch follows the batch load: the pages are parsed once and
    the flat set is written to the lake (partition ``batch_id``); the id
    profile and the join read that Parquet.
    Unique ids take the join without a shuffle; a repeated id fails the
    batch unless ``on_duplicate_ids="join"`` (relational join, rows multiply).
    Progress is kept in ``checkpoint_path`` (pages) and beside it, in ``<checkpoint_path>_keys`` (keys
    and their state); the two belong together.
    ``progress`` gets (query, input rows) of every micro-batch of the two queries.
    """
    batches: list[int] = []
    lake_path = lake_path.rstrip("/")

    def run(query, name: str) -> None:
        query.awaitTermination()
        if progress is not None:
            progress.extend((name, p["numInputRows"]) for p in query.recentProgress if p["numInputRows"])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if not path_exists(spark, f"{lake_path}/{RUN_COLUMN}={batch_id}/_SUCCESS"):
            flat = explode_invoices(batch).select(*[f.name for f in schemas.FLAT.fields])
            write_run_partition(flat, lake_path, batch_id)
        n_rows, unique, _ = id_profile(read_run_partition(spark, lake_path, schemas.FLAT, batch_id))
        if n_rows == 0:
            return
        if not unique and on_duplicate_ids == "fail":
            raise ValueError(f"micro-batch {batch_id}: invoice ids repeat across report records")
        strategy = join_strategy if join_strategy != "auto" else ("nested" if unique else "shuffle")

        def store(new_keys: DataFrame, _) -> None:
            # The one action on the keys: each evaluation would look them up again.
            flat = read_run_partition(new_keys.sparkSession, lake_path, schemas.FLAT, batch_id)
            fresh = only_new(flat, new_keys)
            if strategy == "shuffle":                   # the invoices need no look-up of their own
                rows = join_invoice_items(project_invoices(flat, tz), project_items(fresh, tz), null_safe)
            else:
                rows = join_flat(fresh, tz, null_safe, strategy)
            (conform(rows, schemas.INVOICE_DATA_DDL).write.mode("overwrite").option("compression", COMPRESSION)
                .parquet(f"{target_path.rstrip('/')}/{BATCH_COLUMN}={batch_id}"))
            batches.append(batch_id)

        # The lake's files that this query has not met are those of this batch.
        lake = spark.readStream.schema(with_run_column(schemas.FLAT)).parquet(lake_path)
        with _keyed_state(spark):
            keys = (row_keys(lake).dropDuplicates(ROW_KEY).writeStream.foreachBatch(store)
                    .option("checkpointLocation", f"{checkpoint_path.rstrip('/')}_keys")
                    .trigger(availableNow=True).start())
        run(keys, "keys")

    query = (
        page_stream(spark, landing_glob, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    run(query, "pages")
    return len(batches)


def read_ingested(spark: SparkSession, target_path: str) -> DataFrame:
    schema = StructType(list(schemas.INVOICE_DATA_DDL.fields) + [StructField(BATCH_COLUMN, LongType())])
    return spark.read.schema(schema).parquet(target_path)
