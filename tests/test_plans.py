"""Physical-plan properties the design relies on.

Plans are taken with AQE off and automatic broadcast disabled: the plan
Spark would run when no input is small enough to broadcast (the large-data
case).  Each test pins one property: where shuffles happen, what a scan
reads, which partitions it prunes, and that no Python runs in a plan.
"""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import flatten, join, metrics
from ledgerline.plans.catalog import QUERIES
from ledgerline.session import fresh_dir
from ledgerline.sinks import parquet as pq
from ledgerline.sources import fixtures, land_driver_report, read_report

SMOKE_DIR = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


@contextmanager
def large_data_plans(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return sum(1 for ln in text.splitlines()
               if re.search(r"\bExchange\b", ln) and "Broadcast" not in ln)


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: (\S+)", text)


@pytest.fixture(scope="module")
def lake(spark):
    """The sf0.001 report flattened into a lake table, run partitions 1 and 2."""
    path = fresh_dir(spark, "plans-lake")
    flat = flatten.explode_invoices(read_report(spark, land_driver_report(spark, SMOKE_DIR)))
    flat = flat.select(*[f.name for f in schemas.FLAT.fields])
    pq.write_run_partition(flat, path, 1)
    pq.write_run_partition(flat.limit(3), path, 2)
    return path


def test_nested_join_from_the_lake_has_no_shuffle(spark, lake):
    with large_data_plans(spark):
        text = plan(join.join_nested(pq.read_run_partition(spark, lake, schemas.FLAT, 1)))
    assert shuffles(text) == 0
    assert "Join" not in text
    assert "Generate explode" in text
    # Only run 1 is listed: the run filter prunes partitions, it is not a row filter.
    assert re.search(r"PartitionFilters: \[.*run_id.* = 1\)", text)


def test_id_profile_shuffles_only_the_id(spark, lake):
    with large_data_plans(spark):
        text = plan(join.id_profile_frame(pq.read_run_partition(spark, lake, schemas.FLAT, 1)))
    assert read_schemas(text) == ["struct<flat_invoice:struct<invoice:struct<id:string>>>"]
    # Partial count per task before the shuffle on the id, then one global merge.
    assert "partial_count" in text
    assert shuffles(text) == 2


def test_relational_join_is_a_sort_merge_join_without_broadcast(spark, lake):
    flat = pq.read_run_partition(spark, lake, schemas.FLAT, 1)
    with large_data_plans(spark):
        text = plan(join.join_flat(flat, strategy="shuffle"))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert shuffles(text) == 2


def test_relational_join_broadcasts_only_under_the_threshold(spark, lake):
    flat = pq.read_run_partition(spark, lake, schemas.FLAT, 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        small = plan(join.join_flat(flat, strategy="shuffle"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in small          # a few KB, under the 10 MB default


def test_pushed_delta_filter_runs_inside_the_generator(spark):
    pages = read_report(spark, land_driver_report(spark, SMOKE_DIR), schema=schemas.PAGE_HEADERS_ONLY)
    with large_data_plans(spark):
        text = plan(flatten.explode_invoices_since(pages, 7))
    assert re.search(r"Generate explode\(filter\(list", text)
    assert shuffles(text) == 0


def test_lake_write_is_one_scan_with_the_observation_and_no_shuffle(spark):
    from ledgerline.plans.runs import lake_frame

    pages = read_report(spark, land_driver_report(spark, SMOKE_DIR))
    flat, _ = lake_frame(pages, 7)
    with large_data_plans(spark):
        text = plan(flat)
    assert shuffles(text) == 0
    assert "CollectMetrics" in text
    assert text.count("FileScan json") == 1


def test_json_scan_reads_only_the_declared_fields(spark):
    with large_data_plans(spark):
        text = plan(QUERIES["json_page_scan"](spark, SMOKE_DIR))
    assert read_schemas(text) == ["struct<page_no:bigint,list:array<struct<invoice:struct<id:string>>>>"]


def test_fixture_pages_shuffle_each_table_once(spark):
    with large_data_plans(spark):
        text = plan(fixtures.report_pages(spark, SMOKE_DIR))
    assert shuffles(text) == 2
    # Both page-level sides arrive hash-partitioned on the page: the join adds no exchange.
    assert "SortMergeJoin" in text


def test_preview_is_a_top_n_not_a_sort(spark, lake):
    flat = pq.read_run_partition(spark, lake, schemas.FLAT, 1)
    with large_data_plans(spark):
        text = plan(metrics.preview(join.join_nested(flat), 20))
    assert "TakeOrderedAndProject" in text
    assert not re.search(r"\bSort \[", text)


def test_target_read_prunes_to_the_run_and_the_key(spark, lake):
    with large_data_plans(spark):
        keys = pq.read_run_partition(spark, lake, schemas.FLAT, 2).select(F.col("flat_invoice.invoice.id"))
        text = plan(keys)
    assert read_schemas(text) == ["struct<flat_invoice:struct<invoice:struct<id:string>>>"]
    assert re.search(r"PartitionFilters: \[.*run_id.* = 2\)", text)


# Queries that write a table of their own, or check one by an aggregate, when they are built.
EAGER = {"ensure_table", "parquet_roundtrip", "parquet_single_file", "schema_check", "reconcile", "load_empty_delta"}
# Scenarios and their control rows: a snapshot's name, the runs of the table, the mark of the first half.
SCENARIOS = {"load_full", "load_incremental", "load_replay", "control_active_run", "control_close_open", "watermark_cleanup",
             "run_gate", "stream_ingest", "delta_filter", "delta_filter_pushed"}


# Spark reads the columns of the driver's own tables from a file's footer.
FOOTERS = {"employee_report", "mean_steps"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER - SCENARIOS - FOOTERS))
def test_building_a_query_starts_no_job(spark, key):
    QUERIES[key](spark, SMOKE_DIR)                       # the report is landed and flattened once
    sc, group = spark.sparkContext, f"build-{key}"
    sc.setJobGroup(group, key)
    try:
        QUERIES[key](spark, SMOKE_DIR)
        assert list(sc.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_the_joins_read_the_flattened_report(spark):
    for key in ("join_invoice_items_nested", "join_invoice_items_left", "row_count"):
        with large_data_plans(spark):
            text = plan(QUERIES[key](spark, SMOKE_DIR))
        assert "FileScan parquet" in text and "json" not in text, key


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_evaluation_in_any_catalog_query(spark, key):
    text = plan(QUERIES[key](spark, SMOKE_DIR))
    assert not any(node in text for node in PYTHON_NODES), key
