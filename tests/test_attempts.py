"""Runs side by side: leases, a folder per attempt, rejects once, work by fetch."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from unittest.mock import patch

import pytest
from pyspark.sql import functions as F

from conftest import invoice, item, page, write_pages
from ledgerline import schemas
from ledgerline.plans import control, runs
from ledgerline.plans.control import Lease, RunHistory, RunInProgress
from ledgerline.plans.runs import LoadSettings, read_published, read_rejects, read_target, remove_orphans, run_load
from ledgerline.sinks import parquet as pq

# 50 trials take some minutes; the suite runs a few.
TRIALS = int(os.environ.get("LEDGERLINE_TRIALS", "2"))


def _settings(scratch, report, **options):
    base = scratch("attempts")
    return LoadSettings(report_path=report, target_path=f"{base}/target", control_path=f"{base}/control",
                        lake_path=f"{base}/lake", **options)


def _ids(df):
    return sorted(r.invoice_id for r in df.collect())


# --------------------------------------------------------------------- leases

def test_a_second_run_of_the_row_stops_before_it_writes(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])]))
    hist = RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)
    other = hist.lease(1, "another run", 60)
    other.take()                                        # it never writes a thing
    with pytest.raises(RunInProgress, match="another run"):
        run_load(spark, s, run_ts=0)
    assert not os.path.exists(s.lake_path) and not os.path.exists(s.target_path)
    other.release()
    assert run_load(spark, s, run_ts=0).status == "written"


def test_an_expired_lease_is_taken_over_and_its_owner_stops(spark, scratch):
    now = [100.0]
    folder = scratch("lease")
    a, b = (Lease(spark, folder, name, 10, lambda: now[0]) for name in "ab")
    a.take()
    with pytest.raises(RunInProgress):
        b.take()
    now[0] = 109.0
    a.renew()                                           # until 119
    now[0] = 115.0
    with pytest.raises(RunInProgress):
        b.take()
    now[0] = 120.0
    b.take()
    with pytest.raises(RunInProgress, match="taken over by b"):
        a.renew()
    a.release()                                         # not its own any more
    with pytest.raises(RunInProgress):
        a.take()
    b.release()
    a.take()


def test_of_racing_takers_one_gets_the_lease(spark, scratch):
    folder = scratch("race")
    for n in range(15):
        def take(k, n=n):
            try:
                Lease(spark, f"{folder}/{n}", f"owner {k}", 60).take()
                return k
            except RunInProgress:
                return None
        with ThreadPoolExecutor(6) as pool:
            assert len([k for k in pool.map(take, range(6)) if k is not None]) == 1


# ------------------------------------------------------------ attempts and publishing

def test_a_late_write_of_a_losing_run_destroys_nothing(spark, scratch, tmp_path):
    """Run B reaches its target write, run A of the same row runs to its end, then B writes and fails."""
    report = write_pages(tmp_path, [page([invoice("1"), invoice("2")])])
    for _ in range(TRIALS):
        s = _settings(scratch, report, lease_seconds=0)      # a lease that is over at once: both go on
        hist = RunHistory(spark, s.control_path)
        hist.seed(run_ts=0)
        at_write, a_done, failed = threading.Event(), threading.Event(), []
        write = pq.write_attempt

        def held(df, path, run_id, attempt, own=s):
            if path == own.target_path and threading.current_thread().name == "B":
                at_write.set()
                a_done.wait(120)
            write(df, path, run_id, attempt)

        def run_b(own=s, problems=failed):
            with patch.object(Lease, "renew"):               # even if it doesn't look at its lease again
                try:
                    run_load(spark, own, run_ts=0)
                except FileExistsError as e:
                    problems.append(e)

        with patch.object(runs, "write_attempt", held):
            b = threading.Thread(target=run_b, name="B")
            b.start()
            assert at_write.wait(120)
            first = run_load(spark, s, run_ts=0)
            a_done.set()
            b.join(120)
        assert first.status == "written" and len(failed) == 1
        assert _ids(read_published(spark, s)) == _ids(read_target(spark, s.target_path)) == ["1", "2"]
        row = hist.table().where("id = 1").first()
        assert (row.is_active, row.attempt) == ("N", first.attempt)
        assert len(os.listdir(f"{s.target_path}/run_id=1")) == 2
        gone = remove_orphans(spark, s)
        assert len(gone) == 2 and not any(first.attempt in g for g in gone)      # B's lake and target folders
        assert _ids(read_published(spark, s)) == ["1", "2"]


def test_racing_runs_publish_one_complete_table(spark, scratch, tmp_path):
    report = write_pages(tmp_path, [page([invoice(str(i)) for i in range(1, 6)])])
    for _ in range(TRIALS):
        s = _settings(scratch, report, lease_seconds=0)
        RunHistory(spark, s.control_path).seed(run_ts=0)

        def go(_, own=s):
            try:
                return run_load(spark, own, run_ts=0).status
            except (FileExistsError, RunInProgress) as e:
                return type(e).__name__

        with ThreadPoolExecutor(3) as pool:
            ended = list(pool.map(go, range(3)))
        assert ended.count("written") == 1, ended            # a late starter may find nothing new
        assert _ids(read_published(spark, s)) == [str(i) for i in range(1, 6)]
        assert RunHistory(spark, s.control_path).table().where("is_active = 'Y'").count() == 1


def test_another_pipeline_may_publish_meanwhile(spark, scratch):
    hist = RunHistory(spark, scratch("shared"))
    both = control.seed_rows(spark, "one", 0).unionByName(control.seed_rows(spark, "two", 0).withColumn("id", F.lit(2).cast("long")))
    version = hist.publish(both, 0)
    hist.close_and_open(1, 10, "one", 0, based_on=version)
    hist.close_and_open(2, 20, "two", 0, based_on=version)             # made to the newer version
    with pytest.raises(FileExistsError):
        hist.close_and_open(1, 30, "one", 0, based_on=version)         # its row is closed
    active = {r.etl_name: r.filter_col1_value for r in hist.table().where("is_active = 'Y'").collect()}
    assert active == {"one": "10", "two": "20"}


def test_tables_of_runs_without_attempts_stay_readable(spark, scratch, tmp_path):
    """A table written before attempts had folders: run_id=N, and rows that name no attempt."""
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1"), invoice("2")])], name="new"))
    hist = RunHistory(spark, s.control_path)
    hist.publish(control.open_run(control.close_run(control.seed_rows(spark, run_ts=0), 1), 1, run_ts=0), 0)
    old = spark.createDataFrame([("1", "1-1")], "invoice_id string, id string")
    wide = old.select(*[(F.col(f.name) if f.name in old.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in schemas.INVOICE_DATA_DDL.fields])
    pq.write_run_partition(wide, s.target_path, 1)
    assert run_load(spark, s, run_ts=0).mark == 2
    assert [(r.invoice_id, r.run_id) for r in read_published(spark, s).orderBy("run_id").collect()] == [("1", 1), ("2", 2)]


def test_orphans_and_replaced_generations_are_removed_on_request(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])]))
    hist = RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)
    with patch.object(RunHistory, "close_and_open", side_effect=RuntimeError("crash")), pytest.raises(RuntimeError):
        run_load(spark, s, run_ts=0)
    assert remove_orphans(spark, s) == []                              # the run may still be published
    run_load(spark, s, run_ts=0)
    assert len(remove_orphans(spark, s)) == 2
    again = hist.table().withColumn("full_load", F.when(F.col("is_active") == "Y", "Y").otherwise(F.col("full_load")))
    hist.publish(again, hist.current_version())
    run_load(spark, s, run_ts=0)
    assert remove_orphans(spark, s) == []
    assert len(remove_orphans(spark, s, superseded=True)) == 2
    assert _ids(read_published(spark, s)) == ["1"]


# ------------------------------------------------------------------------- rejects

def test_a_reject_is_stored_once(spark, scratch, tmp_path):
    names = iter("abcdef")
    pages = lambda *inv: write_pages(tmp_path, [page(list(inv))], name=next(names))
    x0, x9 = invoice("X0"), invoice("X9")
    s = _settings(scratch, pages(invoice("1"), x0))
    RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)                                                  # the full load takes X0
    for k in (2, 3, 4):                                                 # a cumulative report, three deltas
        grown = [invoice(str(i)) for i in range(1, k + 1)] + [x0, x9, x9, invoice(None)]
        out = run_load(spark, replace(s, report_path=pages(*grown)))
        assert (out.status, out.non_numeric_ids) == ("written", 4)
    got = [(r["id"], r.run_id) for r in read_rejects(spark, s).select("flat_invoice.invoice.id", "run_id").collect()]
    assert sorted(got, key=str) == [("X9", 2), (None, 2)]
    changed = invoice("X9", total=7)                                    # the same id with another content
    run_load(spark, replace(s, report_path=pages(invoice("9"), changed)))
    got = sorted((r["id"] or "", r["total"], r.run_id) for r in read_rejects(spark, s).select(
        "flat_invoice.invoice.id", "flat_invoice.invoice.total", "run_id").collect())
    assert got == [("", 100, 2), ("X9", 7, 5), ("X9", 100, 2)]
    assert _ids(read_published(spark, s)) == ["1", "2", "3", "4", "9", "X0"]


def test_runs_without_rejects_write_none(spark, scratch, tmp_path):
    s = _settings(scratch, write_pages(tmp_path, [page([invoice("1")])], name="a"))
    RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)
    run_load(spark, replace(s, report_path=write_pages(tmp_path, [page([invoice("2")])], name="b")))
    assert not os.path.exists(runs.rejects_path(s)) and not os.path.exists(runs.violations_path(s))
    assert read_rejects(spark, s).count() == 0 and runs.read_violations(spark, s).count() == 0


# ------------------------------------------------------------------------- fetches

def _fetch(tmp_path, name, invoices, finished=True):
    path = write_pages(tmp_path / "fetches", [page(invoices)], name)
    if finished:
        open(f"{path}/_SUCCESS", "w").close()


def test_a_delta_opens_only_fetches_that_no_run_has_loaded(spark, scratch, tmp_path):
    (tmp_path / "fetches").mkdir()
    s = _settings(scratch, str(tmp_path / "fetches"))                   # by fetch, as the folder looks
    hist = RunHistory(spark, s.control_path)
    hist.seed(run_ts=0)
    _fetch(tmp_path, "f1", [invoice("1"), invoice("2")])
    _fetch(tmp_path, "f3", [invoice("5")])
    assert run_load(spark, replace(s, up_to_fetch="f1")).fetches == ("f1",)
    out = run_load(spark, s)
    assert (out.status, out.mark, out.fetches) == ("written", 5, ("f3",))
    _fetch(tmp_path, "f2", [invoice("6")])                              # a late one, named before f3
    _fetch(tmp_path, "f4", [invoice("7")], finished=False)
    pages, names = runs.new_pages(spark, s, control.ACTION_DELTA)
    assert names == ["f2"] and {p.split("/")[-2] for p in pages.inputFiles()} == {"f2"}
    assert run_load(spark, s).fetches == ("f2",)
    assert _ids(read_published(spark, s)) == ["1", "2", "5", "6"]
    assert [list(r.fetches) for r in hist.table().where("is_active = 'N'").orderBy("id").collect()] == [["f1"], ["f3"], ["f2"]]
    assert hist.active_run().first().filter_col2_name is None
    assert run_load(spark, s).status == "empty"
    whole, names = runs.new_pages(spark, s, control.ACTION_FULL)        # a full load takes all finished ones
    assert names == ["f1", "f2", "f3"] and len(whole.inputFiles()) == 3


def test_the_incremental_query_opens_only_the_new_fetch(spark):
    from ledgerline.plans import catalog
    s = catalog._incremental_scenario(spark, "/root/testdata/sf0.001")
    closed = RunHistory(spark, s.control_path).table().where("is_active = 'N'").orderBy("id").collect()
    assert [list(r.fetches) for r in closed] == [["fetch-1"], ["fetch-2"]]
    assert runs.is_by_fetch(spark, s) and not runs.is_by_fetch(spark, replace(s, report_path=f"{s.report_path}/fetch-1"))


def test_the_filter_field_is_a_setting(spark, scratch, tmp_path):
    first = write_pages(tmp_path, [page([invoice("9", date=100), invoice("8", date=200)])], name="a")
    s = _settings(scratch, first, filter_field="date")
    RunHistory(spark, s.control_path).seed(run_ts=0)
    assert run_load(spark, s).mark == 200
    later = write_pages(tmp_path, [page([invoice("1", date=300), invoice("8", date=200), {**invoice("2"), "date": None}])], name="b")
    out = run_load(spark, replace(s, report_path=later))
    assert (out.mark, out.non_numeric_ids) == (300, 1)
    assert _ids(read_published(spark, s)) == ["1", "8", "9"]
    assert [r[0] for r in read_rejects(spark, s).select("flat_invoice.invoice.id").collect()] == ["2"]


def test_items_of_wide_invoices_reach_the_target_whole(spark, scratch, tmp_path):
    many = invoice("1", items=[item(f"1-{k}") for k in range(500)])
    s = _settings(scratch, write_pages(tmp_path, [page([many])]))
    RunHistory(spark, s.control_path).seed(run_ts=0)
    run_load(spark, s)
    assert read_published(spark, s).count() == 500
