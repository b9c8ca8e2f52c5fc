from conftest import invoice, item, page
from ledgerline.streaming import ingest_available, read_ingested


def _land(tmp_path, name, pages):
    import json
    folder = tmp_path / "landing" / name
    folder.mkdir(parents=True)
    with open(folder / "part-0.json", "w") as fh:
        for p in pages:
            fh.write(json.dumps(p) + "\n")


def test_each_landed_fetch_is_ingested_once(spark, scratch, tmp_path):
    base = scratch("stream")
    glob = str(tmp_path / "landing" / "*" / "*.json")
    _land(tmp_path, "fetch-1", [page([invoice("1"), invoice("2")])])
    assert ingest_available(spark, glob, f"{base}/t", f"{base}/c", f"{base}/lake") == 1
    assert ingest_available(spark, glob, f"{base}/t", f"{base}/c", f"{base}/lake") == 0     # nothing new
    # A later fetch that repeats an invoice adds only what is new.
    _land(tmp_path, "fetch-1b", [page([invoice("2"), invoice("3")])])
    assert ingest_available(spark, glob, f"{base}/t", f"{base}/c", f"{base}/lake") == 1
    # A later fetch with a lower (and a non-numeric) id is still picked up.
    _land(tmp_path, "fetch-2", [page([invoice("0", items=[item("0-1"), item("0-2")]), invoice("Z9")])])
    assert ingest_available(spark, glob, f"{base}/t", f"{base}/c", f"{base}/lake") == 1
    got = sorted((r.invoice_id, r.id) for r in read_ingested(spark, f"{base}/t").collect())
    assert got == [("0", "0-1"), ("0", "0-2"), ("1", "1-1"), ("2", "2-1"), ("3", "3-1"), ("Z9", "Z9-1")]


def test_rows_read_per_batch_do_not_grow(spark, scratch, tmp_path):
    """Ten batches, each repeating an invoice of the one before and the very first one."""
    base = scratch("stream")
    glob = str(tmp_path / "landing" / "*" / "*.json")
    read = []
    for k in range(10):
        _land(tmp_path, f"fetch-{k:02d}", [page([invoice(str(i)) for i in (0, k + 1, k + 2)], k)])
        progress = []
        assert ingest_available(spark, glob, f"{base}/t", f"{base}/c", f"{base}/lake", progress=progress) == 1
        read.append(sorted(progress))
    assert read == [[("keys", 3), ("pages", 1)]] * 10
    got = sorted(int(r.invoice_id) for r in read_ingested(spark, f"{base}/t").collect())
    assert got == list(range(12))


def test_several_batches_of_one_run_keep_the_first_row(spark, scratch, tmp_path):
    base = scratch("stream")
    for k in range(4):
        _land(tmp_path, f"fetch-{k}", [page([invoice("1", total=k), invoice(str(10 + k))], k)])
    n = ingest_available(spark, str(tmp_path / "landing" / "*" / "*.json"), f"{base}/t", f"{base}/c", f"{base}/lake",
                         max_files_per_trigger=1)
    assert n == 4
    rows = read_ingested(spark, f"{base}/t").collect()
    assert sorted(r.invoice_id for r in rows) == ["1", "10", "11", "12", "13"]
    assert [r.batch_id for r in rows if r.invoice_id == "1"] == [0]


def test_a_batch_that_dies_after_its_lake_write_is_finished_by_the_next_run(spark, scratch, tmp_path):
    import os
    from unittest.mock import patch

    import pytest
    from ledgerline.streaming import ingest
    base = scratch("stream")
    args = (spark, str(tmp_path / "landing" / "*" / "*.json"), f"{base}/t", f"{base}/c", f"{base}/lake")
    _land(tmp_path, "fetch-1", [page([invoice("1"), invoice("2")])])
    for where in ("id_profile", "only_new"):            # before the keys are looked up, and while they are
        with patch.object(ingest, where, side_effect=RuntimeError("crash")), pytest.raises(Exception, match="crash"):
            ingest_available(*args)
        assert not os.path.exists(f"{base}/t")
    ingest_available(*args)
    assert sorted(r.invoice_id for r in read_ingested(spark, f"{base}/t").collect()) == ["1", "2"]
    _land(tmp_path, "fetch-2", [page([invoice("2"), invoice("3")])])
    assert ingest_available(*args) == 1
    assert sorted(r.invoice_id for r in read_ingested(spark, f"{base}/t").collect()) == ["1", "2", "3"]


def test_rows_without_a_key_are_all_kept(spark, scratch, tmp_path):
    base = scratch("stream")
    args = (spark, str(tmp_path / "landing" / "*" / "*.json"), f"{base}/t", f"{base}/c", f"{base}/lake")
    for k in range(2):
        _land(tmp_path, f"fetch-{k}", [page([invoice(f"1{k}", items=[item(None), item(None)]), invoice("5")], k)])
        ingest_available(*args)
    got = sorted((r.invoice_id, r.id) for r in read_ingested(spark, f"{base}/t").fillna("").collect())
    assert got == [("10", ""), ("10", ""), ("11", ""), ("11", ""), ("5", "5-1")]


def test_repeated_ids_within_a_batch_fail_or_join(spark, scratch, tmp_path):
    import pytest
    base = scratch("stream")
    args = (spark, str(tmp_path / "landing" / "*" / "*.json"), f"{base}/t", f"{base}/c", f"{base}/lake")
    _land(tmp_path, "fetch-1", [page([invoice("7"), invoice("7"), invoice("8")])])
    with pytest.raises(Exception, match="invoice ids repeat"):
        ingest_available(*args)
    assert ingest_available(*args, on_duplicate_ids="join") == 1
    assert sorted(r.invoice_id for r in read_ingested(spark, f"{base}/t").collect()) == ["7"] * 4 + ["8"]
