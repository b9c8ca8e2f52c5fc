import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.sinks import jdbc
from ledgerline.sinks import parquet as pq


def test_dynamic_run_partitions_are_replay_safe(spark, scratch):
    path = scratch("runs")
    one = spark.range(5).select(F.col("id").cast("string").alias("k"))
    two = spark.range(5, 8).select(F.col("id").cast("string").alias("k"))
    pq.write_run_partition(one, path, 1)
    pq.write_run_partition(one, path, 1)           # retried run 1
    pq.write_run_partition(two, path, 2)
    back = spark.read.parquet(path)
    assert back.count() == 8
    assert {r.run_id: r.n for r in back.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {1: 5, 2: 3}
    pq.write_run_partition(one.limit(0), path, 1)  # a retry that selects nothing leaves nothing
    assert spark.read.parquet(path).count() == 3


def test_write_files_is_parallel_unless_asked_otherwise(spark, scratch):
    df = spark.range(1000).repartition(4)
    for n_files, want in ((1, 1), (None, 4)):
        path = scratch("files")
        pq.write_files(df, path, n_files)
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == want
        assert spark.read.parquet(path).count() == 1000


def test_ensure_table_keeps_a_table_without_marker(spark, scratch):
    path = scratch("unmarked")
    spark.range(5).write.parquet(path)
    os.remove(f"{path}/_SUCCESS")
    assert pq.ensure_table(spark, path, spark.range(1).schema) is False
    assert spark.read.parquet(path).count() == 5


def test_ensure_table_once(spark, scratch):
    path = scratch("ddl")
    assert pq.ensure_table(spark, path, schemas.INVOICE_DATA_DDL) is True
    assert pq.ensure_table(spark, path, schemas.INVOICE_DATA_DDL) is False
    back = spark.read.schema(schemas.INVOICE_DATA_DDL).parquet(path)
    assert back.count() == 0 and back.columns == schemas.INVOICE_DATA_DDL_ORDER


def test_conform_matches_by_name(spark):
    df = spark.createDataFrame([(1, "a")], "b bigint, a string")
    out = pq.conform(df, spark.createDataFrame([], "a string, b bigint").schema)
    assert out.columns == ["a", "b"] and tuple(out.first()) == ("a", 1)


# Embedded Derby lives inside the driver JVM: it works in local mode only, where
# the executors share that JVM; on a cluster point the URL at a real database.
DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


def test_jdbc_overwrite_truncates_and_append_is_replay_safe(spark):
    url = "jdbc:derby:memory:ledgerline_test;create=true"
    first = spark.createDataFrame([("1", "1-1", 10), ("1", "1-2", 20)], "invoice_id string, id string, amount bigint")
    jdbc.write_jdbc(first, url, "invoice_data", "overwrite", driver=DERBY)
    jdbc.write_jdbc(first, url, "invoice_data", "overwrite", driver=DERBY)     # truncate, not duplicate
    assert jdbc.read_jdbc(spark, url, "invoice_data", driver=DERBY).count() == 2
    delta = spark.createDataFrame([("2", "2-1", 5)], "invoice_id string, id string, amount bigint")
    jdbc.append_new_rows(spark, delta, url, "invoice_data", driver=DERBY)
    jdbc.append_new_rows(spark, delta, url, "invoice_data", driver=DERBY)  # replay
    back = jdbc.read_jdbc(spark, url, "invoice_data", driver=DERBY)
    assert sorted((r[0], r[1]) for r in back.select(*back.columns[:2]).collect()) == [("1", "1-1"), ("1", "1-2"), ("2", "2-1")]


def test_jdbc_append_creates_a_missing_table(spark):
    url = "jdbc:derby:memory:ledgerline_missing;create=true"
    assert jdbc.table_exists(spark, url, "fresh_table", driver=DERBY) is False
    df = spark.createDataFrame([("1", "1-1")], "invoice_id string, id string")
    jdbc.append_new_rows(spark, df, url, "fresh_table", driver=DERBY)
    assert jdbc.table_exists(spark, url, "fresh_table", driver=DERBY) is True
    assert jdbc.read_jdbc(spark, url, "fresh_table", driver=DERBY).count() == 1


def test_jdbc_append_completes_a_half_written_insert(spark):
    """Repeated rows, two rows of one key and NULL keys: each as often as the run holds it."""
    url = "jdbc:derby:memory:ledgerline_half;create=true"
    rows = [("1", "1-1", 10), ("1", "1-1", 10), ("1", "1-1", 20), (None, "x", 1), (None, None, None)]
    schema = "invoice_id string, id string, amount bigint"
    jdbc.write_jdbc(spark.createDataFrame([rows[0], rows[3]], schema), url, "half", "append", driver=DERBY)
    for _ in range(2):
        jdbc.append_new_rows(spark, spark.createDataFrame(rows, schema), url, "half", driver=DERBY)
    back = [tuple(r) for r in jdbc.read_jdbc(spark, url, "half", driver=DERBY).collect()]
    assert sorted(back, key=str) == sorted(rows, key=str)


def test_document_landing_has_one_document_per_page_file(spark, scratch):
    import glob
    import os

    from ledgerline.sources import fixtures, land_documents, read_report

    path = scratch("docs")
    pages = fixtures.report_pages(spark, "/root/testdata/sf0.001")
    land_documents(pages, path)
    local = path[len("file:"):] if path.startswith("file:") else path
    files = glob.glob(os.path.join(local, "*.json"))
    assert len(files) == pages.count() and not glob.glob(os.path.join(local, "*", ""))      # one flat folder
    for name in files:
        with open(name) as fh:
            assert len(fh.read().splitlines()) == 1
    back = read_report(spark, path, multiline=True)
    assert back.select("page_no").distinct().count() == len(files)
    assert back.selectExpr("sum(size(list))").first()[0] == pages.selectExpr("sum(size(list))").first()[0]
