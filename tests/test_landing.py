"""What a landing, a run and a stream shuffle and write: narrow rows, compressed files, few documents."""

import glob
import gzip
import os
import re

from pyspark.sql import functions as F

from conftest import SMOKE_DIR, invoice, item, page, write_pages
from ledgerline.operators import flatten, join
from ledgerline.sinks import parquet as pq
from ledgerline.sources import fixtures, land_documents, land_driver_report, land_pages, read_report, report
from ledgerline.streaming import ingest


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def parts(path):
    return sorted(glob.glob(os.path.join(local(path), "part-*")))


def bag(df):
    return sorted(map(str, df.collect()))


def some_pages(spark, tmp_path, n=10):
    folder = write_pages(tmp_path, [page([invoice(str(10 * p + i)) for i in range(3)], p) for p in range(n)])
    return read_report(spark, folder)


def test_landed_pages_are_gzipped_and_bounded_per_file(spark, scratch, tmp_path, monkeypatch):
    monkeypatch.setattr(report, "PAGES_PER_FILE", 4)
    pages = some_pages(spark, tmp_path).coalesce(1)
    path = land_pages(pages, scratch("gz"))
    sizes = []
    for name in parts(path):
        assert name.endswith(".json.gz")
        with gzip.open(name, "rt") as fh:
            sizes.append(len(fh.read().splitlines()))
    assert sorted(sizes) == [2, 4, 4]
    assert bag(read_report(spark, path)) == bag(pages)


def test_a_landing_takes_a_third_of_its_json_at_most(spark, scratch):
    path = land_driver_report(spark, SMOKE_DIR)
    raw = sum(len(gzip.open(name).read()) for name in parts(path))
    assert 3 * sum(map(os.path.getsize, parts(path))) < raw


def test_documents_may_hold_several_pages(spark, scratch, tmp_path):
    pages = some_pages(spark, tmp_path)
    path = land_documents(pages, scratch("docs"), pages_per_document=4)
    assert len(parts(path)) == 3                             # pages 0-3, 4-7, 8-9
    assert bag(read_report(spark, path, multiline=True)) == bag(pages)


def test_the_landed_documents_are_fewer_than_the_pages(spark):
    path = land_driver_report(spark, SMOKE_DIR, layout="documents")
    pages = read_report(spark, path, multiline=True)
    assert bag(pages.select("page_no")) == bag(read_report(spark, land_driver_report(spark, SMOKE_DIR)).select("page_no"))
    assert len(parts(path)) == -(-pages.count() // report.PAGES_PER_DOCUMENT)


def test_only_source_columns_cross_the_shuffle_of_a_landing(spark):
    text = fixtures.report_pages(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    shuffled = re.findall(r"Exchange hashpartitioning.*\n[^\n]*Project \[(.*)\]", text)
    assert len(shuffled) == 2
    for columns in shuffled:
        assert not re.search(r"AS (id|unit_amount|date_to|due_date|tax|currency_code|subscription_id)#", columns)


def test_runs_are_written_with_zstd(spark, scratch):
    path = scratch("zstd")
    pq.write_attempt(spark.range(10), path, 1, "a")
    pq.write_run_partition(spark.range(10), path, 2)
    names = parts(f"{path}/run_id=1/attempt=a") + parts(f"{path}/run_id=2")
    assert names and all(name.endswith(".zstd.parquet") for name in names)


def test_new_items_are_found_before_the_join(spark, tmp_path):
    folder = write_pages(tmp_path, [page([
        invoice("1", items=[item("a"), item("b"), item(None)]), invoice("2", items=[item("a"), item("c")]),
        invoice("3", items=[item("a")]), invoice("4", items=[]), invoice(None, items=[item("a")])])])
    flat = flatten.explode_invoices(read_report(spark, folder))
    keys = spark.createDataFrame([("1", "b"), ("2", "a"), ("2", "c"), ("9", "a")], "invoice_id string, id string")
    new = ingest.only_new(flat, keys)
    assert new.columns == flat.columns
    got = {(r[0], tuple(r[1])) for r in new.select("flat_invoice.invoice.id", F.col("flat_invoice.invoice.line_items.id")).collect()}
    assert got == {("1", ("b", None)), ("2", ("a", "c")), ("3", ()), ("4", ()), (None, ("a",))}
    kept = join.join_nested(flat).where("(invoice_id, id) IN (('1', 'b'), ('2', 'a'), ('2', 'c')) OR id IS NULL")
    assert bag(join.join_nested(new)) == bag(kept)
