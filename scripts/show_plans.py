"""Summarise the physical plan of every catalog query into docs/PLANS.md.

Usage: python scripts/show_plans.py [sf_dir]

Plans are taken with AQE off and automatic broadcast disabled, i.e. the
plan Spark would run when every input is too large to broadcast (the
100 TB case).  For each query: shuffle exchanges, joins, scans with their
read schema, generators, and whether any Python evaluation appears.  The
scenario queries (``load_*``, ``control_*`` ...) run their jobs while being
built; their own plan is the read-back of a written table, and the plans of
the load steps are listed separately at the end.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from ledgerline import schemas  # noqa: E402
from ledgerline.operators import flatten, join  # noqa: E402
from ledgerline.plans.catalog import QUERIES  # noqa: E402
from ledgerline.session import fresh_dir, local_session  # noqa: E402
from ledgerline.sinks import parquet as pq  # noqa: E402
from ledgerline.sources import fixtures, land_driver_report, read_report  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarise(text: str) -> dict:
    lines = text.splitlines()
    exchanges = [ln.strip() for ln in lines if re.search(r"\bExchange\b", ln) and "Broadcast" not in ln]
    bexchanges = [ln for ln in lines if "BroadcastExchange" in ln]
    joins = sorted({m.group(0) for ln in lines for m in re.finditer(r"\b\w*Join\b(?= \[|\s)", ln)
                    if not m.group(0).startswith("Hashed")})
    scans = []
    for ln in lines:
        m = re.search(r"FileScan (\w+) .*?ReadSchema: (\S+)", ln)
        if m:
            rs = m.group(2)
            scans.append(f"{m.group(1)} {rs if len(rs) < 90 else rs[:87] + '...'}")
    python = any(k in text for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                     "MapInPandas", "PythonUDF"))
    return {
        "shuffles": len(exchanges),
        "broadcasts": len(bexchanges),
        "joins": ", ".join(joins) or "-",
        "generate": sum("Generate" in ln for ln in lines),
        "top_n": "TakeOrderedAndProject" in text,
        "scans": scans,
        "python": python,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores="8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    out = ["# Physical plans", "",
           f"Generated by `scripts/show_plans.py` on `{sf_dir}` with AQE off and automatic",
           "broadcast disabled (the plan for inputs too large to broadcast). `shuffles` counts",
           "`Exchange` nodes; `python` would flag any Python evaluation in the plan.", "",
           "| Query | Shuffles | Broadcasts | Joins | Generate | Top-n | Python | Scans (format, read schema) |",
           "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for key, q in QUERIES.items():
        s = summarise(plan_text(q(spark, sf_dir)))
        scans = "<br>".join(f"`{x}`" for x in s["scans"]) or "-"
        out.append(f"| `{key}` | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['generate']} | "
                   f"{'yes' if s['top_n'] else '-'} | {'YES' if s['python'] else 'no'} | {scans} |")

    # The steps of a load run, and the fixture builder.
    pages = read_report(spark, land_driver_report(spark, sf_dir))
    lake_path = fresh_dir(spark, "plans-lake")
    pq.write_run_partition(flatten.explode_invoices(pages), lake_path, 1)
    lake = pq.read_run_partition(spark, lake_path, schemas.FLAT, 1)
    ids = lake.select(F.col(f"{flatten.INV}.id").alias("id"))
    steps = {
        "fixture: report_pages (tables -> nested pages)": fixtures.report_pages(spark, sf_dir),
        "load step: explode with pushed delta filter": flatten.explode_invoices_since(pages, 7000),
        "load step: id profile on the lake (first aggregate)": ids.groupBy("id").count(),
        "load step: join from the lake, nested": join.join_nested(lake),
        "load step: join from the lake, relational fallback": join.join_flat(lake, strategy="shuffle"),
    }
    out += ["", "## Load-run steps and the fixture builder", "",
            "| Step | Shuffles | Broadcasts | Joins | Generate | Python | Scans |",
            "| --- | --- | --- | --- | --- | --- | --- |"]
    trees = []
    for name, df in steps.items():
        text = plan_text(df)
        s = summarise(text)
        scans = "<br>".join(f"`{x}`" for x in s["scans"]) or "-"
        out.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['generate']} | "
                   f"{'YES' if s['python'] else 'no'} | {scans} |")
        short = "\n".join(ln[:160] for ln in text.splitlines())
        trees += ["", f"### {name}", "", "```", short, "```"]
    out += ["", "## Plan trees of the load steps"] + trees
    dest = ROOT / "docs" / "PLANS.md"
    dest.parent.mkdir(exist_ok=True)
    dest.write_text("\n".join(out) + "\n")
    print(f"wrote {dest}")


if __name__ == "__main__":
    main()
