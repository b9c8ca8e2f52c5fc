"""Tables that keep their definition (SNK-05), nested schema checks (SC-01), fingerprints (SC-03)."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ledgerline import schemas
from ledgerline.operators import checks
from ledgerline.sinks import parquet as pq

TABLE = StructType([StructField("k", StringType(), False), StructField("n", IntegerType(), True)])


def test_writes_are_held_to_the_definition(spark, scratch):
    path = scratch("defined")
    assert pq.ensure_table(spark, path, TABLE) is True
    kept = pq.table_definition(spark, path)
    assert kept.schema == TABLE and kept.partition_by == ()
    pq.insert_into(spark.createDataFrame([(1, "a"), (None, "b")], "n int, k string"), path)      # by name
    for rows, schema, said in [
            ([("1", "a")], "n string, k string", "n: int is defined, string given"),
            ([("a",)], "k string", "n: missing"),
            ([(1, "a", 2)], "n int, k string, more int", "more: not defined")]:
        with pytest.raises(pq.DefinitionMismatch, match=said):
            pq.insert_into(spark.createDataFrame(rows, schema), path)
    with pytest.raises(Exception, match="NULL in NOT NULL column k"):
        pq.insert_into(spark.createDataFrame([(1, "z"), (2, None)], "n int, k string").repartition(2), path)
    back = spark.read.schema(TABLE).parquet(path).collect()
    assert sorted((r.k, r.n) for r in back if r.k != "z") == [("a", 1), ("b", None)]
    assert "z" not in {r.k for r in back}                     # nothing of a refused write is committed


def test_a_folder_without_definition_takes_no_insert(spark, scratch):
    path = scratch("undefined")
    spark.createDataFrame([("a", 1)], TABLE).write.parquet(path)
    assert pq.ensure_table(spark, path, TABLE) is False and pq.table_definition(spark, path) is None
    with pytest.raises(pq.DefinitionMismatch, match="no definition"):
        pq.insert_into(spark.createDataFrame([("a", 1)], TABLE), path)


def test_of_racing_creators_one_defines_the_table(spark, scratch):
    path = scratch("race")
    other = StructType([StructField("x", StringType())])
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda k: pq.define_table(spark, path, (TABLE, other)[k % 2]), range(4)))
    assert sum(made) == 1 and pq.table_definition(spark, path).schema == (TABLE, other)[made.index(True) % 2]


def test_partitioned_tables_keep_their_partitioning(spark, scratch):
    path = scratch("parts")
    pq.ensure_table(spark, path, TABLE, ["n"])
    pq.insert_into(spark.createDataFrame([("a", 1), ("b", 2)], TABLE), path)
    assert sorted(r.k for r in spark.read.parquet(path).where("n = 2").collect()) == ["b"]
    assert pq.table_definition(spark, path).partition_by == ("n",)


def test_a_load_refuses_a_target_of_another_shape(spark, scratch, tmp_path):
    from conftest import invoice, page, write_pages
    from ledgerline.plans.control import RunHistory
    from ledgerline.plans.runs import LoadSettings, run_load
    base = scratch("shape")
    s = LoadSettings(write_pages(tmp_path, [page([invoice("1")])]), f"{base}/t", f"{base}/c", f"{base}/l")
    RunHistory(spark, s.control_path).seed(run_ts=0)
    pq.define_table(spark, s.target_path, TABLE)
    with pytest.raises(pq.DefinitionMismatch):
        run_load(spark, s)
    assert RunHistory(spark, s.control_path).current_version() == 1


# ---------------------------------------------------------------------------- SC-01

def test_schema_diff_walks_nested_fields(spark):
    items = StructType([f if f.name != "quantity" else StructField("quantity", StringType()) for f in schemas.LINE_ITEM.fields
                        if f.name != "amount"] + [StructField("extra", IntegerType())])
    inv = StructType([f if f.name != "line_items" else StructField("line_items", ArrayType(items)) for f in schemas.INVOICE.fields])
    pages = StructType([schemas.PAGE["page_no"], schemas.PAGE["next_offset"],
                        StructField("list", ArrayType(StructType([StructField("invoice", inv)])))])
    got = {r.column_name: r for r in checks.schema_diff(spark, spark.createDataFrame([], pages), schemas.PAGE, profile=True).collect()}
    at = "list.invoice.line_items"
    odd = {k: (r.status, r.expected_type, r.actual_type) for k, r in got.items() if r.status != "ok"}
    assert odd == {f"{at}.quantity": ("type_mismatch", "bigint", "string"), f"{at}.amount": ("missing", "bigint", None),
                   f"{at}.extra": ("unexpected", None, "int")}
    assert (got["list"].actual_type, got[at].actual_type, got["list.invoice"].actual_type) == ("array<struct>", "array<struct>", "struct")
    assert got["page_no"].non_null == 0 and got[f"{at}.id"].non_null is None
    flat = checks.schema_diff(spark, spark.createDataFrame([], pages), schemas.PAGE, nested=False).collect()
    assert [r.status for r in flat] == ["ok", "ok", "type_mismatch"]


def test_schema_diff_tells_what_may_be_null(spark):
    want = StructType([StructField("k", StringType(), False), StructField("m", StructType([StructField("x", IntegerType(), False)]), False)])
    have = StructType([StructField("k", StringType(), True), StructField("m", StructType([StructField("x", IntegerType(), True)]), False)])
    df = spark.createDataFrame([], have)
    assert {r.status for r in checks.schema_diff(spark, df, want).collect()} == {"ok"}
    got = {r.column_name: r.status for r in checks.schema_diff(spark, df, want, nullability=True).collect()}
    assert got == {"k": "nullable", "m": "ok", "m.x": "nullable"}


def test_schema_diff_walks_maps_and_nested_arrays(spark):
    a = spark.createDataFrame([], "m map<string, struct<x: int>>, l array<array<struct<y: int>>>, `a.b` int")
    b = spark.createDataFrame([], "m map<string, struct<x: long>>, l array<array<struct<y: int>>>, `a.b` int").schema
    got = {r.column_name: r.status for r in checks.schema_diff(spark, a, b, profile=True).collect()}
    assert got == {"m": "ok", "m.value.x": "type_mismatch", "l": "ok", "l.y": "ok", "a.b": "ok"}


# ---------------------------------------------------------------------------- SC-03

def _side(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, m int")


ROWS = [("a", None, 1), (None, "a", 1), ("a", None, 1), ("b", "x", None), (None, None, None), ("c", "", 5)]


def test_reconcile_counts_differing_rows_as_bags(spark):
    same = checks.reconcile(_side(spark, ROWS).repartition(3), _side(spark, ROWS[::-1]), "m").first()
    assert (same.n_differing_rows, same.actual_rows, same.expected_rows) == (0, 6, 6) and same.actual_avg == 2.0
    for change, n in [(ROWS[1:], 1), (ROWS + [ROWS[0]], 1), ([("a", None, 2), *ROWS[1:]], 2),
                      ([(None, "a", 1)] + ROWS[1:], 2), ([], 6)]:
        for ranges in (1, 7, 1024):
            assert checks.reconcile(_side(spark, change), _side(spark, ROWS), "m", ranges).first().n_differing_rows == n
    none = checks.reconcile(_side(spark, []), _side(spark, []), "m").first()
    assert (none.actual_rows, none.n_differing_rows, none.actual_avg) == (0, 0, None)


def test_fingerprints_shuffle_sums_and_not_rows(spark):
    df = _side(spark, ROWS * 50)
    prints = checks.fingerprints(df, df.columns, "m")
    text = prints._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert moved and all("range" in m or "pmod" in m or "_groupingexpression" in m for m in moved)
    assert prints.count() <= 5


def test_equal_sides_need_no_exchange_of_rows(spark):
    from unittest.mock import patch
    with patch.object(checks, "_differing_rows", side_effect=AssertionError("rows compared")):
        checks.reconcile(_side(spark, ROWS), _side(spark, ROWS), "m")
        with pytest.raises(AssertionError, match="rows compared"):
            checks.reconcile(_side(spark, ROWS), _side(spark, ROWS[1:]), "m")


def test_only_ranges_that_differ_are_compared(spark):
    rows = [(str(i), "v", i) for i in range(3000)]
    a, b = _side(spark, rows), _side(spark, rows[:-1] + [("2999", "w", 2999)])
    from unittest.mock import patch
    seen = []
    compare = checks._differing_rows
    with patch.object(checks, "_differing_rows", side_effect=lambda *x: seen.append(x[3]) or compare(*x)):
        assert checks.reconcile(a, b, "m").first().n_differing_rows == 2
    assert 1 <= len(seen[0]) <= 2


def test_counts_by_measure_match_plain_aggregates(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("m"))
    got = checks.reconcile(df, df, "m").first()
    want = df.agg(F.avg("m")).first()[0]
    assert got.actual_avg == pytest.approx(want) and got.actual_rows == 1000
