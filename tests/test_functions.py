import pytest
from pyspark.sql import functions as F

from ledgerline.functions import (
    bool_text, clean_watermark, format_epoch, join_names, numeric_id, parse_watermark, times,
)


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_epoch_edges_utc(spark):
    got = _one(spark, format_epoch("e"), [(None,), (0,), (-1,)], "e bigint")
    assert got == [None, "1970-01-01 00:00:00.000", "1969-12-31 23:59:59.000"]


def test_dst_change_new_york(spark):
    # 2024-03-10 07:00:00 UTC is when New York clocks jump from 02:00 to 03:00.
    got = _one(spark, format_epoch("e", "America/New_York"), [(1710053999,), (1710054000,)], "e bigint")
    assert got == ["2024-03-10 01:59:59.000", "2024-03-10 03:00:00.000"]


def test_zone_argument_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = _one(spark, format_epoch("e", "UTC"), [(0,)], "e bigint")
        parity = _one(spark, format_epoch("e", None), [(0,)], "e bigint")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["1970-01-01 00:00:00.000"]
    assert parity == ["1970-01-01 09:00:00.000"]      # reference behaviour: session zone


def test_numeric_id_and_text_max(spark):
    df = spark.createDataFrame([("9",), ("10",), ("X1",), (None,)], "id string")
    row = df.agg(F.max(numeric_id("id")).alias("n"), F.max("id").alias("t")).first()
    assert row["n"] == 10 and row["t"] == "X1"
    assert _one(spark, numeric_id("id"), [("9",), ("X1",)], "id string") == [9, None]


def test_clean_watermark(spark):
    got = _one(spark, clean_watermark("v"), [(None,), ("null",), ("123",), (" 7 ",)], "v string")
    assert got == [0, 0, 123, 7]


@pytest.mark.parametrize("text", ["x", " null", "NULL"])
def test_clean_watermark_rejects_text(spark, text):
    # Only NULL and the exact text 'null' stand for "no mark"; anything else
    # that is not an integer fails instead of reloading everything.
    df = spark.createDataFrame([(text,)], "v string").select(clean_watermark("v"))
    with pytest.raises(Exception, match="non-numeric watermark"):
        df.collect()


def test_parse_watermark():
    assert parse_watermark(None) == 0
    assert parse_watermark("null") == 0
    assert parse_watermark("42") == 42
    assert parse_watermark(" 7 ") == 7
    for text in ("x", " null", "NULL"):
        with pytest.raises(ValueError):
            parse_watermark(text)


def test_bool_text(spark):
    assert _one(spark, bool_text("b"), [(True,), (False,), (None,)], "b boolean") == ["true", "false", None]


def test_join_names_skips_null(spark):
    got = _one(spark, join_names("a", "b"), [(None, "Moor"), ("Tova", "Moor"), ("Tova", None)], "a string, b string")
    assert got == ["Moor", "Tova Moor", "Tova"]


def test_times_overflow_raises(spark):
    df = spark.createDataFrame([(2 ** 62,)], "f bigint").select(times("f", 21))
    with pytest.raises(Exception):
        df.collect()
