from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR, invoice, item, page, write_pages
from ledgerline import schemas
from ledgerline.plans import control
from ledgerline.plans.runs import LoadSettings, read_published, read_rejects, read_target, read_violations, run_load
from ledgerline.sources import land_driver_report


def _settings(scratch, report):
    base = scratch("run")
    return LoadSettings(report_path=report, target_path=f"{base}/target",
                        control_path=f"{base}/control", lake_path=f"{base}/lake")


def _bag(df):
    return Counter(tuple(r) for r in df.drop("run_id").collect())


def _crash(spark, s, **options):
    """A run that dies after its writes, before it publishes."""
    from unittest.mock import patch
    with patch.object(control.RunHistory, "close_and_open", side_effect=RuntimeError("crash")):
        with pytest.raises(RuntimeError, match="crash"):
            run_load(spark, s, **options)


def test_full_delta_empty_replay(spark, scratch):
    top = spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").agg(F.max("o_orderkey")).first()[0]
    half = top // 2
    s = _settings(scratch, land_driver_report(spark, SMOKE_DIR, max_order_key=half))
    hist = control.RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)

    r1 = run_load(spark, s, run_ts=0)
    assert (r1.action, r1.status, r1.mark) == ("full", "written", half)

    s2 = replace(s, report_path=land_driver_report(spark, SMOKE_DIR))
    _crash(spark, s2, run_ts=0)
    assert read_published(spark, s).select("run_id").distinct().count() == 1     # not visible yet
    r2 = run_load(spark, s2, run_ts=0)                 # retry of the same run
    assert (r2.action, r2.status, r2.mark) == ("delta", "written", top)
    r3 = run_load(spark, s2, run_ts=0)                 # nothing new
    assert r3.status == "empty"

    target = read_target(spark, s.target_path)
    # Same rows as one full load of the whole report, no duplicates.
    s_full = _settings(scratch, s2.report_path)
    control.RunHistory(spark, s_full.control_path).seed(run_ts=0)
    run_load(spark, s_full, run_ts=0)
    assert _bag(target) == _bag(read_target(spark, s_full.target_path))
    assert sorted(r.run_id for r in target.select("run_id").distinct().collect()) == [1, 2]

    table = hist.table().orderBy("id").collect()
    assert [(r.id, r.is_active, r.full_load, r.filter_col1_value) for r in table] == [
        (1, "N", "Y", None), (2, "N", "N", str(half)), (3, "Y", "N", str(top))]


def test_no_active_row_skips(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])]))
    assert run_load(spark, s).status == "skipped"


def test_skip_and_noop_rows(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])]))
    hist = control.RunHistory(spark, s.control_path)
    seed = control.seed_rows(spark, run_ts=0)
    hist.publish(seed.withColumn("skip_execution", F.lit("Y")))
    assert run_load(spark, s).status == "skipped"
    hist.publish(seed.withColumn("full_load", F.lit("X")))
    assert run_load(spark, s).status == "noop"


def test_non_numeric_mark_fails_before_writing(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])]))
    hist = control.RunHistory(spark, s.control_path)
    hist.publish(control.seed_rows(spark, run_ts=0)
                 .withColumn("full_load", F.lit("N")).withColumn("filter_col1_value", F.lit("x")))
    with pytest.raises(ValueError):
        run_load(spark, s)
    from ledgerline.session import path_exists
    assert not path_exists(spark, s.target_path)
    assert hist.current_version() == 1


def test_null_text_mark_loads_everything_once(spark, scratch, tmp_path):
    report = write_pages(tmp_path, [page([invoice("1"), invoice("2")])])
    s = _settings(scratch, report)
    hist = control.RunHistory(spark, s.control_path)
    hist.publish(control.seed_rows(spark, run_ts=0)
                 .withColumn("full_load", F.lit("N")).withColumn("filter_col1_value", F.lit("null")))
    r = run_load(spark, s)
    assert (r.action, r.status, r.mark) == ("delta", "written", 2)
    assert read_target(spark, s.target_path).count() == 2
    assert run_load(spark, s).status == "empty"


def test_run_without_numeric_ids_keeps_previous_mark(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("A1"), invoice("B2")])]))
    hist = control.RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)
    r = run_load(spark, s)
    assert r.status == "written" and r.mark is None
    assert hist.active_run().first().filter_col1_value is None


def test_target_schema_is_the_ddl(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1", items=[item("1-1")])])]))
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)
    target = read_target(spark, s.target_path)
    assert target.columns[:-1] == schemas.INVOICE_DATA_DDL_ORDER
    assert target.first().invoice_id == "1"


def test_jdbc_target_full_delta_replay(spark, scratch):
    # Embedded in-memory Derby: visible to this JVM only, so local mode only.
    url = "jdbc:derby:memory:ledgerline_runs;create=true"
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    top = spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").agg(F.max("o_orderkey")).first()[0]
    s = replace(_settings(scratch, land_driver_report(spark, SMOKE_DIR, max_order_key=top // 2)),
                target_format="jdbc", jdbc_url=url, jdbc_driver=driver)
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    assert run_load(spark, s).status == "written"
    s2 = replace(s, report_path=land_driver_report(spark, SMOKE_DIR))
    _crash(spark, s2)
    assert run_load(spark, s2).status == "written"
    from ledgerline.sinks.jdbc import read_jdbc
    got = read_jdbc(spark, url, "invoice_data", driver)
    full = _settings(scratch, s2.report_path)
    control.RunHistory(spark, full.control_path).seed(run_ts=0)
    run_load(spark, full)
    assert got.count() == read_target(spark, full.target_path).count()


def test_job_cli(spark, scratch, tmp_path, capsys):
    import json
    from ledgerline.plans import job
    base = scratch("cli")
    report = write_pages(tmp_path, [page([invoice("1"), invoice("2")])])
    argv = ["--report", report, "--target", f"{base}/t", "--control", f"{base}/c", "--lake", f"{base}/l",
            "--seed", "--tz", "Europe/Berlin"]
    out = job.main(argv)
    assert out["status"] == "written" and out["mark"] == 2
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["action"] == "full"
    assert job.main(argv)["status"] == "empty"
    dates = {r.invoice_date for r in read_target(spark, f"{base}/t").collect()}
    assert dates == {"1970-01-01 01:00:00.000"}


def test_duplicate_ids_fail_the_run_or_join_on_request(spark, scratch, tmp_path):
    from ledgerline.plans.runs import DuplicateInvoiceIds
    from ledgerline.operators import flatten, join
    from ledgerline.sources import read_report
    dup = invoice("7", items=[item("7-1")])
    report = write_pages(tmp_path, [page([dup], 0), page([dup, invoice("8")], 1)])
    s = _settings(scratch, report)
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    with pytest.raises(DuplicateInvoiceIds):
        run_load(spark, s)
    from ledgerline.session import path_exists
    assert not path_exists(spark, f"{s.target_path}/run_id=1")
    dups = join.duplicate_ids(flatten.explode_invoices(read_report(spark, report))).collect()
    assert [(r.id, r.records) for r in dups] == [("7", 2)]
    r = run_load(spark, replace(s, on_duplicate_ids="join"))
    assert r.status == "written"
    assert read_target(spark, s.target_path).where(F.col("invoice_id") == "7").count() == 4


def test_empty_full_load_creates_the_target(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [{"page_no": 0, "list": []}]))
    hist = control.RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)
    r = run_load(spark, s)
    assert (r.action, r.status) == ("full", "empty")
    assert read_target(spark, s.target_path).count() == 0
    assert hist.current_version() == 1          # history untouched


def test_non_numeric_ids_of_a_delta_are_rejected_not_lost(spark, scratch, tmp_path):
    first = write_pages(tmp_path, [page([invoice("1"), invoice("X0")])], name="first")
    second = write_pages(tmp_path, [page([invoice("1"), invoice("2"), invoice("X1"), invoice("Y2")])],
                         name="second")
    s = _settings(scratch, first)
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    full = run_load(spark, s)
    # A full load writes every invoice, but a non-numeric id never sets the mark.
    assert (full.status, full.mark, full.non_numeric_ids) == ("written", 1, 1)
    delta = run_load(spark, replace(s, report_path=second))
    assert (delta.status, delta.mark, delta.non_numeric_ids) == ("written", 2, 2)
    ids = sorted(r.invoice_id for r in read_target(spark, s.target_path).collect())
    assert ids == ["1", "2", "X0"]
    rejected = sorted(r[0] for r in read_rejects(spark, s).select("flat_invoice.invoice.id").collect())
    assert rejected == ["X1", "Y2"]                     # with the target: all that the run selected


def test_null_ids_of_a_delta_are_rejected_not_lost(spark, scratch, tmp_path):
    first = write_pages(tmp_path, [page([invoice("1")])], name="first")
    second = write_pages(tmp_path, [page([invoice("1"), invoice("2"), invoice(None), invoice("X1")])], name="second")
    s = _settings(scratch, first)
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)
    delta = run_load(spark, replace(s, report_path=second))
    assert (delta.status, delta.mark, delta.non_numeric_ids) == ("written", 2, 2)
    rejected = [r[0] for r in read_rejects(spark, s).select("flat_invoice.invoice.id").collect()]
    assert len(rejected) == 2 and set(rejected) == {None, "X1"}


def test_a_retry_that_selects_nothing_keeps_no_stale_rows(spark, scratch, tmp_path):
    pages = lambda name, *ids: write_pages(tmp_path, [page([invoice(i) for i in ids])], name=name)
    s = _settings(scratch, pages("a", "1", "2"))
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)
    _crash(spark, replace(s, report_path=pages("b", "1", "2", "3", "4")))
    assert run_load(spark, replace(s, report_path=pages("c", "1", "2"))).status == "empty"
    assert sorted(r.invoice_id for r in read_published(spark, s).collect()) == ["1", "2"]
    # Once there is something new, the run's partition holds just that.
    assert run_load(spark, replace(s, report_path=pages("d", "1", "2", "5"))).status == "written"
    assert sorted(r.invoice_id for r in read_published(spark, s).collect()) == ["1", "2", "5"]


def test_a_retry_that_joins_to_nothing_keeps_no_stale_rows(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])], name="a"))
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)
    _crash(spark, replace(s, report_path=write_pages(tmp_path, [page([invoice("2")])], name="b")))
    run_load(spark, replace(s, report_path=write_pages(tmp_path, [page([invoice("2", items=[])])], name="c")))
    assert [r.invoice_id for r in read_published(spark, s).collect()] == ["1"]


def test_a_failing_full_load_leaves_the_old_table_readable(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])], name="a"))
    hist = control.RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)
    run_load(spark, s)
    version = hist.current_version()
    again = hist.table().withColumn("full_load", F.when(F.col("is_active") == "Y", "Y").otherwise(F.col("full_load")))
    hist.publish(again, version)                        # the next run is a full load
    s2 = replace(s, report_path=write_pages(tmp_path, [page([invoice("8"), invoice("9")])], name="b"))
    _crash(spark, s2)
    assert [r.invoice_id for r in read_published(spark, s).collect()] == ["1"]
    run_load(spark, s2)
    assert sorted(r.invoice_id for r in read_published(spark, s).collect()) == ["8", "9"]


def _fetch(tmp_path, name, invoices, finished=True):
    path = write_pages(tmp_path / "fetches", [page(invoices)], name)
    if finished:
        open(f"{path}/_SUCCESS", "w").close()
    return path


def test_a_delta_reads_only_later_fetches(spark, scratch, tmp_path):
    (tmp_path / "fetches").mkdir()
    s = replace(_settings(scratch, str(tmp_path / "fetches")), by_fetch=True)
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    first = _fetch(tmp_path, "f1", [invoice("1"), invoice("2")])
    assert run_load(spark, s, run_ts=0).status == "written"
    assert run_load(spark, s, run_ts=0).status == "empty"          # no later fetch
    with open(f"{first}/pages.json", "w") as fh:                   # a run that reads f1 again fails
        fh.write("{ not json")
    _fetch(tmp_path, "f2", [invoice("2"), invoice("3")])
    _fetch(tmp_path, "f3", [invoice("4")], finished=False)
    _fetch(tmp_path, "f4", [invoice("5")])                         # waits for f3
    out = run_load(spark, s, run_ts=0)
    assert (out.action, out.status, out.mark) == ("delta", "written", 3)
    assert sorted(r.invoice_id for r in read_published(spark, s).collect()) == ["1", "2", "3"]
    open(tmp_path / "fetches" / "f3" / "_SUCCESS", "w").close()
    assert run_load(spark, s, run_ts=0).mark == 5
    assert sorted(r.invoice_id for r in read_published(spark, s).collect()) == ["1", "2", "3", "4", "5"]
    row = control.RunHistory(spark, s.control_path).active_run().first()
    assert (row.filter_col2_name, row.filter_col2_value) == ("fetch", "f4")


def test_rows_that_break_the_contract_go_to_violations(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1"), invoice("2", due_date=None)])]))
    control.RunHistory(spark, s.control_path).seed(run_ts=0)
    out = run_load(spark, s, run_ts=0)
    assert (out.status, out.violations) == ("written", 1)
    assert [r.invoice_id for r in read_published(spark, s).collect()] == ["1"]
    assert [r.invoice_id for r in read_violations(spark, s).collect()] == ["2"]
