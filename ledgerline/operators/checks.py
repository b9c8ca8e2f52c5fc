"""Schema and data checks (SC-01, SC-02, SC-03).

Checks are one-pass aggregates that return small DataFrames, so they run on
the executors and only their one-row results reach the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def field_paths(schema: StructType, top_only: bool = False) -> dict[str, tuple[str, bool]]:
    """Type and nullability by dotted path, in order.

    Structs are walked through arrays (``list.invoice.line_items.id``), map values
    as ``path.value``.  A walked field has the kind of its container only (``struct``,
    ``array<struct>``), so that a change inside is reported where it is.
    """
    out: dict[str, tuple[str, bool]] = {}

    def inner(kind: DataType) -> tuple[str, StructType | None, str]:
        """(what to call it, the struct inside, path below)."""
        if isinstance(kind, StructType):
            return "struct", kind, ""
        if isinstance(kind, ArrayType):
            name, struct, below = inner(kind.elementType)
            return f"array<{name}>", struct, below
        if isinstance(kind, MapType):
            name, struct, below = inner(kind.valueType)
            return f"map<{kind.keyType.simpleString()},{name}>", struct, f".value{below}"
        return kind.simpleString(), None, ""

    def walk(struct: StructType, prefix: str) -> None:
        for f in struct.fields:
            name, own, below = inner(f.dataType)
            path = f"{prefix}{f.name}"
            out[path] = (f.dataType.simpleString() if top_only else name, f.nullable)
            if own is not None and not top_only:
                walk(own, f"{path}{below}.")

    walk(schema, "")
    return out


def schema_diff(spark: SparkSession, df: DataFrame, expected: StructType,
                profile: bool = False, nested: bool = True, nullability: bool = False) -> DataFrame:
    """Compare a DataFrame's schema with a declared one (SC-01).

    One row per field in either schema, nested ones by dotted path (``nested``): expected
    type, actual type and a status of ``ok``, ``type_mismatch``, ``missing``,
    ``unexpected``, or with ``nullability`` ``nullable`` for a NOT NULL field that may be NULL
    here (off by default: a file read makes every field nullable).  A field inside a missing or
    unexpected one has the same status.  With ``profile=True`` a ``non_null`` count per present
    column is added (NULL for nested fields), computed by one aggregate pass over the
    data (only that one row of counts reaches the driver).
    """
    actual, wanted = field_paths(df.schema, not nested), field_paths(expected, not nested)
    names = list(wanted) + [n for n in actual if n not in wanted]
    counts = {}
    if profile:
        present = [f.name for f in df.schema.fields]
        row = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in present]).first()
        counts = {n: row[n] for n in present}
    rows = []
    for pos, name in enumerate(names):
        (e, e_null), (a, a_null) = wanted.get(name, (None, True)), actual.get(name, (None, True))
        if e is None:
            status = "unexpected"
        elif a is None:
            status = "missing"
        elif e != a:
            status = "type_mismatch"
        else:
            status = "nullable" if nullability and a_null and not e_null else "ok"
        rows.append((pos, name, e, a, status) + ((counts.get(name),) if profile else ()))
    schema = "position int, column_name string, expected_type string, actual_type string, status string"
    if profile:
        schema += ", non_null bigint"
    return spark.createDataFrame(rows, schema)


def contract_violations(df: DataFrame, not_null: list[str]) -> DataFrame:
    """NOT NULL contract in one pass (SC-02): one row of counts.

    ``n_rows``, ``n_violating_rows`` and ``null_<column>`` per listed column.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count(F.when(violates(not_null), 1)).alias("n_violating_rows")]
    aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in not_null]
    return df.agg(*aggs)


def violates(not_null: list[str]) -> Column:
    """True where a row lacks one of the columns (never NULL)."""
    return reduce(or_, (F.col(c).isNull() for c in not_null))


def split_valid(df: DataFrame, not_null: list[str]):
    """(valid rows, rejected rows) by the NOT NULL contract; both lazy."""
    return df.where(~violates(not_null)), df.where(violates(not_null))


RANGES = 1024


def fingerprints(df: DataFrame, columns: list[str], measure: str, ranges: int = RANGES) -> DataFrame:
    """An additive fingerprint of the rows of each range of row hashes: (range, n_rows, h1,
    h2, n_measure, sum_measure).

    Two sides that hold the same rows as often have equal fingerprints in every range; two
    64-bit hashes are added up as decimals, so rows in another order, or split over other
    files, give the same sums.  NULLs take part by a mark of their own.  Only sums leave a task.
    """
    marks = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    cells = [F.col(c) for c in columns]
    hashed = df.select(F.xxhash64(*cells, marks).alias("__h1"), F.xxhash64(F.lit(7), marks, *reversed(cells)).alias("__h2"),
                       F.col(measure).alias("__m"))
    return hashed.groupBy(F.pmod("__h1", F.lit(ranges)).cast("int").alias("range")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("__h1").cast("decimal(38,0)")).alias("h1"), F.sum(F.col("__h2").cast("decimal(38,0)")).alias("h2"),
        F.count("__m").alias("n_measure"), F.sum("__m").alias("sum_measure"))


def reconcile(actual: DataFrame, expected: DataFrame, measure: str, ranges: int = RANGES) -> DataFrame:
    """Reconcile two tables (SC-03): one row of side-by-side metrics.

    Column count, row count and mean of ``measure`` per side, whether every
    actual column exists in the expected table, and the number of rows that
    differ as bags (duplicates count).

    Each side is reduced to fingerprints of ``ranges`` ranges of row hashes, so no whole
    row is shuffled.  These (a row per range and side) reach the driver, which names the ranges
    that differ.  Only the rows of those are compared themselves, grouped on all columns; when no
    range differs the sides are equal as bags (but for a collision of 128 bits).
    """
    cols = list(expected.columns)
    contained = all(c in expected.columns for c in actual.columns)
    sides = {"a": actual.select(*cols), "e": expected.select(*cols)}
    prints = reduce(DataFrame.unionByName, (
        fingerprints(df, cols, measure, ranges).withColumn("side", F.lit(side)) for side, df in sides.items()))
    held = {side: {} for side in sides}
    for r in prints.collect():
        held[r["side"]][r["range"]] = r
    same = lambda r, k: (r["n_rows"], r["h1"], r["h2"]) == (k["n_rows"], k["h1"], k["h2"]) if r and k else r is k
    apart = sorted(k for k in {*held["a"], *held["e"]} if not same(held["a"].get(k), held["e"].get(k)))
    differing = _differing_rows(sides["a"], sides["e"], cols, apart, ranges) if apart else 0

    def mean(side):
        n = sum(r["n_measure"] for r in held[side].values())
        return float(sum(r["sum_measure"] for r in held[side].values() if r["n_measure"]) / n) if n else None

    row = (len(actual.columns), len(expected.columns), *(sum(r["n_rows"] for r in held[s].values()) for s in "ae"),
           mean("a"), mean("e"), differing, contained)
    return actual.sparkSession.createDataFrame([row], (
        "actual_cols bigint, expected_cols bigint, actual_rows bigint, expected_rows bigint, actual_avg double, "
        "expected_avg double, n_differing_rows bigint, columns_contained boolean"))


def _differing_rows(actual: DataFrame, expected: DataFrame, cols: list[str], apart: list[int], ranges: int) -> int:
    """Rows that one side holds more often, within some ranges of row hashes."""
    marks = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    here = F.pmod(F.xxhash64(*[F.col(c) for c in cols], marks), F.lit(ranges)).isin(apart)
    tagged = (actual.where(here).withColumn("__n", F.lit(1))
              .unionByName(expected.where(here).withColumn("__n", F.lit(-1))))
    more = tagged.groupBy(*cols).agg(F.abs(F.sum("__n")).alias("__n"))
    return int(more.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0])
