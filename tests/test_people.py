from ledgerline.operators import checks, metrics, people
from ledgerline.schemas import EMPLOYEES
from ledgerline.sources import inline_rows

# Invented names; floors as in the reference's fixture.
ROWS = [(1, "Ada", "Park", 1), (2, "Ben", "Quill", 1), (3, "Cai", "Rowe", 2), (4, None, "Sand", 2),
        (5, "Eli", "Tate", 3), (6, "Fay", "Urry", 3), (7, "Gus", "Vale", 4), (8, "Hal", "Wynn", 4)]


def test_employee_report(spark):
    report = people.transform_employees(inline_rows(spark, ROWS, EMPLOYEES))
    assert report.columns == ["id", "name", "steps_to_desk"]
    got = [tuple(r) for r in report.orderBy("id").collect()]
    assert [g[2] for g in got] == [21, 21, 42, 42, 63, 63, 84, 84]
    assert got[3][1] == "Sand"                     # NULL first name: no stray space
    assert report.count() == 8
    assert metrics.mean_of(report, "steps_to_desk").first()[0] == 52.5


def test_reconcile_detects_differences(spark):
    src = inline_rows(spark, ROWS, EMPLOYEES)
    actual = people.transform_employees(src)
    same = checks.reconcile(actual, people.transform_employees(src), "steps_to_desk").first()
    assert (same.actual_rows, same.expected_rows, same.n_differing_rows, same.columns_contained) == (8, 8, 0, True)
    assert same.actual_avg == same.expected_avg == 52.5
    other = people.transform_employees(src.where("id <> 8").union(src.where("id = 1")))
    diff = checks.reconcile(actual, other, "steps_to_desk").first()
    assert diff.n_differing_rows == 2 and diff.expected_rows == 8


def test_contract_violations_and_split(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), (None, None)], "p string, q string")
    row = checks.contract_violations(df, ["p", "q"]).first()
    assert (row.n_rows, row.n_violating_rows, row.null_p, row.null_q) == (3, 2, 2, 1)
    valid, rejects = checks.split_valid(df, ["p", "q"])
    assert valid.count() == 1 and rejects.count() == 2


def test_schema_diff(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    df = spark.createDataFrame([(1, "a", 2)], "a bigint, b string, c int")
    want = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("d", StringType())])
    got = {r.column_name: r.status for r in checks.schema_diff(spark, df, want).collect()}
    assert got == {"a": "ok", "b": "type_mismatch", "d": "missing", "c": "unexpected"}
    prof = {r.column_name: r.non_null for r in checks.schema_diff(spark, df, want, profile=True).collect()}
    assert prof == {"a": 1, "b": 1, "d": None, "c": 1}
