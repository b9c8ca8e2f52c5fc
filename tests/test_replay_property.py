"""Randomised run sequences: crashes and retries never lose or duplicate rows."""

import json
from collections import Counter
from contextlib import suppress
from unittest.mock import patch

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import invoice, item, page
from ledgerline.operators import flatten, join
from ledgerline.plans import control
from ledgerline.plans.runs import LoadSettings, read_published, run_load
from ledgerline.sources import read_report

steps = st.lists(st.tuples(st.integers(0, 3), st.booleans()), min_size=1, max_size=4)


def _write(folder, invoices):
    folder.mkdir(parents=True)
    with open(folder / "p.json", "w") as fh:
        for i in range(0, max(len(invoices), 1), 2):
            fh.write(json.dumps(page(invoices[i:i + 2], i // 2)) + "\n")
    return str(folder)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(plan=steps)
def test_any_sequence_of_runs_and_crashes(spark, scratch, tmp_path_factory, plan):
    root = tmp_path_factory.mktemp("seq")
    base = scratch("seq")
    settings_ = None
    invoices, next_id = [], 1
    for k, (n_new, crash) in enumerate(plan):
        for _ in range(n_new):
            invoices.append(invoice(str(next_id), items=[item(f"{next_id}-1"), item(f"{next_id}-2")]))
            next_id += 1
        report = _write(root / f"fetch-{k}", invoices)       # each fetch returns everything so far
        s = LoadSettings(report_path=report, target_path=f"{base}/t", control_path=f"{base}/c",
                         lake_path=f"{base}/l")
        if settings_ is None:
            control.RunHistory(spark, s.control_path).seed(run_ts=0)
        settings_ = s
        if crash:
            # Dies before it publishes, unless there was nothing to publish.
            with patch.object(control.RunHistory, "close_and_open", side_effect=RuntimeError("crash")):
                with suppress(RuntimeError):
                    run_load(spark, s, run_ts=0)
        run_load(spark, s, run_ts=0)
        run_load(spark, s, run_ts=0)                          # an immediate re-run adds nothing

    hist = control.RunHistory(spark, settings_.control_path)
    active = hist.table().where(F.col("is_active") == "Y").collect()
    assert len(active) == 1
    if invoices:
        assert active[0].filter_col1_value == str(next_id - 1)
        target = read_published(spark, settings_).drop("run_id")
        expected = join.join_flat(flatten.explode_invoices(read_report(spark, settings_.report_path)))
        cols = sorted(expected.columns)
        assert Counter(tuple(r) for r in target.select(*cols).collect()) == \
            Counter(tuple(r) for r in expected.select(*cols).collect())
