"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR

QUERIES = entry.QUERIES          # the queries of the llm package have tests of their own
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["orders", "lineitem", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(SMOKE_DIR) / (t + '.parquet')}')")
    return con


def _norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMOKE_DIR)
    res = duck.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "run_id"
