import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import fresh_dir, local_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="ledgerline-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder under the shared scratch root."""
    return lambda label="t": fresh_dir(spark, label)


def item(iid, customer="c1", subscription="s1", date_from=0, amount=100, quantity=1, is_taxed=True):
    return {"id": iid, "customer_id": customer, "subscription_id": subscription,
            "date_from": date_from, "date_to": date_from + 86400, "amount": amount,
            "unit_amount": amount // max(quantity, 1), "quantity": quantity,
            "discount_amount": 0, "item_level_discount_amount": 0, "is_taxed": is_taxed}


def invoice(iid, customer="c1", subscription="s1", items=None, date=0, paid_at=None, total=100, **extra):
    inv = {"id": iid, "customer_id": customer, "subscription_id": subscription, "status": "paid",
           "currency_code": "EUR", "date": date, "due_date": date + 30 * 86400, "total": total,
           "amount_paid": total, "amount_due": 0, "tax": total // 10,
           "line_items": items if items is not None else [item(f"{iid}-1", customer, subscription)]}
    if paid_at is not None:
        inv["paid_at"] = paid_at
    inv.update(extra)
    return inv


def write_pages(tmp_path, pages, name="report"):
    """Write pages as line-delimited JSON (one page per line) and return the folder."""
    folder = tmp_path / name
    folder.mkdir()
    with open(folder / "pages.json", "w") as fh:
        for p in pages:
            fh.write(json.dumps(p) + "\n")
    return str(folder)


def page(invoices, page_no=0):
    return {"page_no": page_no, "list": [{"invoice": i} for i in invoices]}
