"""Property tests: the shuffle-free rewrites equal their literal forms on random reports."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import invoice, item, page
from ledgerline import schemas
from ledgerline.operators import flatten, join

customers = st.sampled_from(["c1", "c2"])
subs = st.sampled_from(["s1", "s2", None])
ids = st.one_of(st.integers(0, 30).map(str), st.sampled_from(["X1", "007", None]))


@st.composite
def reports(draw, unique_ids):
    n = draw(st.integers(0, 8))
    raw_ids = draw(st.lists(ids, min_size=n, max_size=n, unique=unique_ids))
    invoices = []
    for k, iid in enumerate(raw_ids):
        cust, sub = draw(customers), draw(subs)
        items = draw(st.one_of(st.none(), st.lists(
            st.tuples(customers, subs), max_size=3)))
        line_items = None if items is None else [
            item(f"{k}-{j}", c, s) for j, (c, s) in enumerate(items)]
        invoices.append(invoice(iid, cust, sub, items=line_items if line_items is not None else [],
                                **({"line_items": None} if items is None else {})))
    pages = [page(invoices[i:i + 3], i // 3) for i in range(0, len(invoices), 3)] or [page([])]
    return pages


def _df(spark, pages):
    rows = [(p["page_no"], None, [(inv,) for inv in (x["invoice"] for x in p["list"])]) for p in pages]
    return spark.createDataFrame(_as_rows(rows), schemas.PAGE)


def _as_rows(rows):
    fields = [f.name for f in schemas.INVOICE.fields]
    item_fields = [f.name for f in schemas.LINE_ITEM.fields]
    out = []
    for page_no, nxt, lst in rows:
        invs = []
        for (inv,) in lst:
            li = inv.get("line_items")
            li = None if li is None else [tuple(it.get(f) for f in item_fields) for it in li]
            invs.append((tuple(li if f == "line_items" else inv.get(f) for f in fields),))
        out.append((page_no, nxt, invs))
    return out


def _bag(df):
    return Counter(df.toJSON().collect())


SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(pages=reports(unique_ids=True), null_safe=st.booleans(), how=st.sampled_from(["inner", "left"]))
def test_nested_join_equals_relational_join(spark, pages, null_safe, how):
    flat = flatten.explode_invoices(_df(spark, pages))
    nested = join.join_flat(flat, null_safe=null_safe, strategy="nested", how=how)
    relational = join.join_flat(flat, null_safe=null_safe, strategy="shuffle", how=how)
    assert _bag(nested) == _bag(relational)


@settings(**SETTINGS)
@given(pages=reports(unique_ids=False), mark=st.integers(-2, 25), outer=st.booleans())
def test_filter_before_explode_equals_filter_after(spark, pages, mark, outer):
    df = _df(spark, pages)
    before = flatten.explode_invoices_since(df, mark, outer)
    after = flatten.delta_filter(flatten.explode_invoices(df, outer), mark)
    assert _bag(before) == _bag(after)


@settings(**SETTINGS)
@given(pages=reports(unique_ids=False))
def test_auto_join_is_exact_with_duplicates(spark, pages):
    flat = flatten.explode_invoices(_df(spark, pages))
    relational = join.join_invoice_items(flatten.project_invoices(flat), flatten.project_items(flat))
    assert _bag(join.join_flat(flat, strategy="auto")) == _bag(relational)
