import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.functions import columns as C


def _one(spark, expr, value, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
    return df.select(expr.alias("y")).first()["y"]


def test_code_and_text(spark):
    assert _one(spark, C.code("x"), " aa ") == "AA"
    assert _one(spark, C.text("x"), "  New York ") == "New York"
    assert _one(spark, C.code("x"), None) is None


def test_trim_removes_spaces_only(spark):
    assert _one(spark, C.text("x"), "\tx ") == "\tx"


def test_null_if_spellings(spark):
    for s in ("", "NULL", "null"):
        assert _one(spark, C.null_if("x"), s) is None
    assert _one(spark, C.null_if("x"), "Null") == "Null"


def test_try_convert(spark):
    assert _one(spark, C.try_convert("x", T.LongType()), "1.5") == 2
    assert _one(spark, C.try_convert("x", T.LongType()), "220") == 220
    assert _one(spark, C.try_convert("x", T.LongType()), "n/a") is None
    assert _one(spark, C.try_convert("x", T.DoubleType()), "5541.0") == 5541.0
    assert _one(spark, C.try_convert("x", T.DoubleType()), "abc") is None
    assert _one(spark, C.try_convert("x", T.DateType()), "2026-04-21") == dt.date(2026, 4, 21)
    assert _one(spark, C.try_convert("x", T.DateType()), "2026-13-01") is None


def test_route_key_null_propagates(spark):
    df = spark.createDataFrame([("JFK", "LHR"), ("JFK", None)], "a string, b string")
    assert [r[0] for r in df.select(C.route_key("a", "b")).collect()] == ["JFK-LHR", None]


def test_differs_null_is_false(spark):
    df = spark.createDataFrame([("USA", "UK"), (" USA", "USA "), (None, "UK")], "a string, b string")
    assert [r[0] for r in df.select(C.differs("a", "b")).collect()] == [True, False, False]


def test_bucket_boundaries(spark):
    vals = [-1.0, 0.0, 1499.9, 1500.0, 3999.9, 4000.0, 20000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(C.bucket("d")).collect()]
    assert got == ["SHORT", "SHORT", "SHORT", "MEDIUM", "MEDIUM", "LONG", "LONG", "LONG"]


def test_number_text(spark):
    vals = [5541.0, 1234.5, 1.0e7, 100.0, 0.0, -1.0, 0.25]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(C.number_text("d")).collect()]
    assert got == ["5541", "1234.5", "10000000", "100", "0", "-1", "0.25"]
    assert _one(spark, C.number_text("x"), 220, T.LongType()) == "220"


def test_flag_contradicts_nulls(spark):
    rows = [(True, "A", "A"), (True, "A", "B"), (False, "A", "B"), (False, "A", "A"), (None, "A", "A"), (True, None, "A")]
    df = spark.createDataFrame(rows, "f boolean, a string, b string")
    got = [r[0] for r in df.select(F.coalesce(C.flag_contradicts("f", "a", "b"), F.lit(False))).collect()]
    assert got == [True, False, True, False, False, False]


def test_outside_inclusive_and_null(spark):
    df = spark.createDataFrame([(90.0,), (-90.0,), (95.0,), (None,)], "v double")
    got = [r[0] for r in df.select(F.coalesce(C.outside("v", -90, 90), F.lit(False))).collect()]
    assert got == [False, False, True, False]
