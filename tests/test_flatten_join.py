from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import invoice, item, page, write_pages
from ledgerline.operators import flatten, join, metrics
from ledgerline.sources import read_report


def _pages(spark, tmp_path, pages, **kw):
    return read_report(spark, write_pages(tmp_path, pages), **kw)


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_siblings_stay_and_list_is_dropped(spark, tmp_path):
    flat = flatten.explode_invoices(_pages(spark, tmp_path, [page([invoice("1")], page_no=7)]))
    assert "list" not in flat.columns and "page_no" in flat.columns
    assert flat.select("page_no").first()[0] == 7


def test_numeric_mark_beats_text_max(spark, tmp_path):
    p = _pages(spark, tmp_path, [page([invoice("9"), invoice("10")])])
    row = metrics.max_invoice_id(flatten.project_invoices(flatten.explode_invoices(p))).first()
    assert row["max_invoice_id"] == 10 and row["max_invoice_id_text"] == "9"


@pytest.mark.parametrize("pushed", [False, True])
def test_strict_bound(spark, tmp_path, pushed):
    p = _pages(spark, tmp_path, [page([invoice("9"), invoice("10")])])
    flat = (flatten.explode_invoices_since(p, 9) if pushed
            else flatten.delta_filter(flatten.explode_invoices(p), 9))
    assert [r.id for r in flatten.project_invoices(flat).collect()] == ["10"]


@pytest.mark.parametrize("mark", [None, 0, -5])
def test_full_load_bypass(spark, tmp_path, mark):
    p = _pages(spark, tmp_path, [page([invoice("9"), invoice("10"), invoice("X1")])])
    _, inv, _ = flatten.load_invoices(p, mark)
    assert inv.count() == 3


def test_non_numeric_id_left_out_of_delta_and_listed(spark, tmp_path):
    p = _pages(spark, tmp_path, [page([invoice("5"), invoice("X1"), invoice("12")])])
    flat = flatten.explode_invoices(p)
    assert sorted(r.id for r in flatten.project_invoices(flatten.delta_filter(flat, 3)).collect()) == ["12", "5"]
    rejects = flatten.reject_non_numeric(flat)
    assert [r[0] for r in rejects.select("flat_invoice.invoice.id").collect()] == ["X1"]


def test_empty_page(spark, tmp_path):
    p = _pages(spark, tmp_path, [{"page_no": 0, "list": []}])
    flat, inv, items = flatten.load_invoices(p)
    assert inv.count() == 0 and items.count() == 0
    assert join.join_flat(flat).count() == 0


def test_missing_field_reads_as_null(spark, tmp_path):
    p = _pages(spark, tmp_path, [page([invoice("1"), invoice("2", paid_at=86400)])])
    got = {r.id: r.invoice_paid_date for r in flatten.project_invoices(flatten.explode_invoices(p)).collect()}
    assert got == {"1": None, "2": "1970-01-02 00:00:00.000"}


def test_items_carry_parent_id_and_text_flag(spark, tmp_path):
    inv = invoice("4", items=[item("a", is_taxed=True), item("b", is_taxed=False)])
    items = flatten.project_items(flatten.explode_invoices(_pages(spark, tmp_path, [page([inv])])))
    assert sorted((r.invoice_id, r.id, r.is_taxed_item) for r in items.collect()) == [
        ("4", "a", "true"), ("4", "b", "false")]


def _edge_report(spark, tmp_path):
    return _pages(spark, tmp_path, [page([
        invoice("1"),                                                      # matches
        invoice("2", subscription=None, items=[item("2-1", subscription=None)]),   # NULL key
        invoice("3", items=[]),                                            # no items
        invoice("4", items=None, line_items=None),                         # NULL items
        invoice("5", items=[item("5-1", customer="c-1")]),                 # customer mismatch
    ])])


def test_inner_join_edges(spark, tmp_path):
    flat = flatten.explode_invoices(_edge_report(spark, tmp_path))
    for strategy in ("nested", "shuffle", "auto"):
        rows = join.join_flat(flat, strategy=strategy).collect()
        assert [(r.invoice_id, r.id) for r in rows] == [("1", "1-1")], strategy


def test_null_safe_keeps_null_subscription(spark, tmp_path):
    flat = flatten.explode_invoices(_edge_report(spark, tmp_path))
    for strategy in ("nested", "shuffle"):
        rows = join.join_flat(flat, null_safe=True, strategy=strategy).collect()
        assert sorted((r.invoice_id, r.id) for r in rows) == [("1", "1-1"), ("2", "2-1")], strategy


def test_outer_explode_and_left_join_keep_invoices_without_items(spark, tmp_path):
    flat = flatten.explode_invoices(_edge_report(spark, tmp_path))
    outer = flatten.project_items(flat, outer=True)
    assert sorted(r.invoice_id for r in outer.where(F.col("id").isNull()).collect()) == ["3", "4"]
    for strategy in ("nested", "shuffle"):
        left = join.join_flat(flat, how="left", strategy=strategy)
        got = Counter((r.id, r.invoice_id) for r in left.collect())
        # 1 matches; 2 (NULL key), 3, 4 (no items) and 5 (mismatch) keep one NULL row each
        assert got == Counter({("1-1", "1"): 1, (None, None): 4}), strategy


def test_nested_equals_relational_join_on_driver_data(spark):
    from ledgerline.sources import land_driver_report
    flat = flatten.explode_invoices(read_report(spark, land_driver_report(spark, "/root/testdata/sf0.001")))
    nested = join.join_nested(flat)
    relational = join.join_invoice_items(flatten.project_invoices(flat), flatten.project_items(flat))
    assert nested.columns == relational.columns
    assert _bag(nested) == _bag(relational)


def test_duplicate_ids_fall_back_to_relational_join(spark, tmp_path):
    # The same invoice delivered on two pages: the relational join pairs every
    # copy with every item of every copy; ``auto`` must detect the duplicate.
    dup = invoice("7", items=[item("7-1")])
    p = _pages(spark, tmp_path, [page([dup], 0), page([dup, invoice("8")], 1)])
    flat = flatten.explode_invoices(p)
    n_rows, unique, mark = join.id_profile(flat)
    assert (n_rows, unique, mark) == (3, False, 8)
    auto = join.join_flat(flat, strategy="auto")
    relational = join.join_invoice_items(flatten.project_invoices(flat), flatten.project_items(flat))
    assert _bag(auto) == _bag(relational)
    assert auto.where(F.col("invoice_id") == "7").count() == 4


def test_multiline_report(spark, tmp_path):
    import json
    folder = tmp_path / "ml"
    folder.mkdir()
    (folder / "report.json").write_text(json.dumps(page([invoice("1"), invoice("2")]), indent=2))
    p = read_report(spark, str(folder), multiline=True)
    assert flatten.project_invoices(flatten.explode_invoices(p)).count() == 2


def test_malformed_page_fails_fast(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "p.json").write_text('{"page_no": 1, "list": [\n')
    with pytest.raises(Exception):
        flatten.explode_invoices(read_report(spark, str(folder))).count()


def test_inferred_schema_parity_and_its_failure_mode(spark, tmp_path):
    p = read_report(spark, write_pages(tmp_path, [page([invoice("1")])]), schema=None)
    assert flatten.project_items(flatten.explode_invoices(p)).count() == 1
    # No page carries paid_at: inference cannot see the field, the declared schema can.
    with pytest.raises(Exception):
        flatten.project_invoices(flatten.explode_invoices(p)).collect()


def test_delta_filter_on_another_numeric_field(spark, tmp_path):
    p = _pages(spark, tmp_path, [page([invoice("1", total=50), invoice("2", total=500)])])
    flat = flatten.explode_invoices_since(p, 100, field="total")
    assert [r.id for r in flatten.project_invoices(flat).collect()] == ["2"]


def test_source_file_lineage(spark, tmp_path):
    p = read_report(spark, write_pages(tmp_path, [page([invoice("1")])]), with_source=True)
    files = [r.source_file for r in p.select("source_file").collect()]
    assert len(files) == 1 and files[0].endswith("pages.json")
