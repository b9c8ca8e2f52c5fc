from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerline import schemas
from ledgerline.plans import control


def _rows(spark, rows):
    full = []
    for r in rows:
        base = dict(id=None, etl_name="invoice-data", skip_execution="N", is_active="Y", full_load="N",
                    run_date=None, filter_col1_name="invoice_id", filter_col1_value=None,
                    filter_col2_name=None, filter_col2_value=None)
        base.update(r)
        full.append(tuple(base[f.name] for f in schemas.HISTORY.fields))
    return spark.createDataFrame(full, schemas.HISTORY)


def test_newest_active_row_wins(spark):
    h = _rows(spark, [dict(id=1), dict(id=2, filter_col1_value="5"), dict(id=3, is_active="N")])
    got = control.newest(control.active_runs(h)).collect()
    assert [(r.id, r.filter_col1_value) for r in got] == [(2, "5")]


def test_other_pipeline_rows_are_ignored(spark):
    h = _rows(spark, [dict(id=1, etl_name="other")])
    assert control.active_runs(h).count() == 0


def test_gate_actions(spark):
    h = _rows(spark, [dict(id=1, full_load="Y"), dict(id=2), dict(id=3, skip_execution="Y"),
                      dict(id=4, full_load="X")])
    got = {r.id: r.action for r in control.with_action(h).collect()}
    assert got == {1: "full", 2: "delta", 3: "skip", 4: "noop"}


def test_null_skip_flag_skips(spark):
    # Only an explicit 'N' lets a run go ahead; NULL full_load is a no-op.
    # A file read makes every column nullable, whatever the DDL says.
    rows = _rows(spark, [dict(id=1, full_load="Y"), dict(id=2)]).collect()
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schemas.HISTORY.fields])
    h = spark.createDataFrame(
        [rows[0].asDict() | {"skip_execution": None}, rows[1].asDict() | {"full_load": None}], nullable)
    got = {r.id: r.action for r in control.with_action(h).collect()}
    assert got == {1: "skip", 2: "noop"}


def test_close_and_open(spark):
    h = _rows(spark, [dict(id=1, full_load="Y"), dict(id=2, is_active="N")])
    out = control.open_run(control.close_run(h, 1), 42, run_ts=0).orderBy("id").collect()
    assert [(r.id, r.is_active, r.full_load, r.filter_col1_value) for r in out] == [
        (1, "N", "Y", None), (2, "N", "N", None), (3, "Y", "N", "42")]


def test_versions_and_partial_snapshot(spark, scratch):
    path = scratch("ctl")
    hist = control.RunHistory(spark, path)
    assert hist.current_version() is None and hist.table().count() == 0
    assert hist.seed(run_ts=0) is True
    assert hist.seed(run_ts=0) is False            # idempotent
    hist.close_and_open(1, 10, run_ts=0)
    assert hist.current_version() == 2
    # A snapshot whose marker was never created (crash while publishing) is ignored.
    spark.createDataFrame([], schemas.HISTORY).write.parquet(f"{path}/snapshots/crashed")
    assert hist.current_version() == 2
    active = hist.active_run().collect()
    assert [(r.id, r.filter_col1_value) for r in active] == [(2, "10")]
    assert hist.table().where(F.col("is_active") == "Y").count() == 1
    assert hist.close_and_open(2, 20, run_ts=0) == 3
    assert hist.current_version() == 3
    assert [(r.id, r.filter_col1_value) for r in hist.active_run().collect()] == [(3, "20")]


def test_of_racing_publishers_one_wins(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    hist = control.RunHistory(spark, scratch("race"))
    hist.seed(run_ts=0)

    def publish(run_id, version):
        try:
            return hist.close_and_open(run_id, 1, run_ts=0, based_on=version)
        except FileExistsError:
            return None

    with ThreadPoolExecutor(4) as pool:
        for run_id in range(1, 13):
            version = hist.current_version()
            won = list(pool.map(lambda _: publish(run_id, version), range(4)))
            assert [w for w in won if w] == [version + 1]
    assert hist.table().where("is_active = 'Y'").count() == 1


def test_markers_are_created_once(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    from ledgerline.session import create_exclusive

    base = scratch("marker")

    def create(path, content):
        try:
            create_exclusive(spark, path, content)
            return content
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        for n in range(60):
            path = f"{base}/v={n}"
            won = [w for w in pool.map(lambda k: create(path, str(k)), range(8)) if w]
            assert len(won) == 1 and spark.read.text(path).first()[0] == won[0] if n % 20 == 0 else len(won) == 1
