import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stratiform.functions import expr as X


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_round_half_even_matches_vectorised_float_rounding(spark):
    vals = [0.125, -0.125, 1.005, 2.675, 0.135, None]
    got = _one(spark, X.round_half_even("x"), [(v,) for v in vals], "x double")
    assert got == [0.12, -0.12, 1.0, 2.68, 0.14, None]


def test_spark_round_differs_which_is_why_rint_is_used(spark):
    # bround/round work on the decimal expansion: 1.005 -> 1.01 there
    got = _one(spark, F.round("x", 2), [(1.005,)], "x double")
    assert got == [1.01]


def test_nan_to_null_and_aggregates_skip_it(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = df.select(F.avg(X.nan_to_null("x")).alias("m"), F.max(X.nan_to_null("x")).alias("mx")).first()
    assert r.m == 2.0 and r.mx == 3.0
    # without the rule Spark treats NaN as the largest value
    assert math.isnan(df.select(F.max("x")).first()[0])


def test_to_double_from_text(spark):
    got = _one(spark, X.to_double("s"), [("12.5",), ("NaN",), (None,)], "s string")
    assert got == [12.5, None, None]


def test_to_id_strict_and_lenient(spark):
    df = spark.createDataFrame([("433",), ("x1",)], "s string")
    assert [r[0] for r in df.select(X.to_id("s", strict=False)).collect()] == [433, None]
    with pytest.raises(Exception):
        df.select(X.to_id("s", strict=True)).collect()


def test_bool_or_false(spark):
    got = _one(spark, X.bool_or_false("b"), [(True,), (False,), (None,)], "b boolean")
    assert got == [True, False, False]


def test_parse_feed_formats(spark):
    df = spark.createDataFrame([("2015-Sep-08 20:28", "2015-09-08")], "full string, day string")
    r = df.select(X.parse_timestamp("full", X.FEED_TIME_FORMAT).alias("f"),
                  X.parse_timestamp("day", X.FEED_DAY_FORMAT).alias("d")).first()
    assert str(r.f) == "2015-09-08 20:28:00" and str(r.d) == "2015-09-08 00:00:00"
    out = df.select(X.parse_timestamp("full", X.FEED_TIME_FORMAT).alias("ts"))
    assert dict(out.dtypes)["ts"] == "timestamp_ntz"
    r2 = out.select(X.day_of("ts").alias("d"), X.hour_of("ts").alias("h")).first()
    assert str(r2.d) == "2015-09-08" and r2.h == 20


# (name, number, provisional, has_number) -- edge rows of the name split
NAMES = [
    ("433 Eros (A898 PA)", "433", "A898 PA", True),
    ("(2020 AB)", None, "2020 AB", False),
    ("2021 no paren", "2021", None, True),
    ("a (b) c (d)", None, "b) c (d", False),
    ("()", None, None, False),
    (" 12 X", None, None, False),
    ("433", None, None, False),
    (None, None, None, None),
]


@pytest.mark.parametrize("name,number,prov,has", NAMES)
def test_name_split(spark, name, number, prov, has):
    df = spark.createDataFrame([(name,)], "name string")
    r = df.select(X.official_number("name"), X.provisional_designation("name"),
                  X.has_official_number("name")).first()
    assert tuple(r) == (number, prov, has)


def test_rebuilt_name_loses_the_middle_word(spark):
    df = spark.createDataFrame([("433 Eros (A898 PA)",), ("(2020 AB)",)], "name string")
    got = [r[0] for r in df.select(X.rebuilt_name(X.official_number("name"),
                                                  X.provisional_designation("name"))).collect()]
    assert got == ["433 (A898 PA)", "(2020 AB)"]


def test_risk_flag_and_uncertainty(spark):
    df = spark.createDataFrame([(True, False, 1.0, 3.5), (False, False, 2.0, 2.0)],
                               "h boolean, s boolean, lo double, hi double")
    got = df.select(X.risk_flag("h", "s"), X.diameter_uncertainty("hi", "lo")).collect()
    assert [tuple(r) for r in got] == [(True, 2.5), (False, 0.0)]


def test_window_is_inclusive_by_day_and_pushes_down(spark):
    from stratiform.sources.window import feed_window, window_text
    assert window_text("2024-01-10") == ("2024-01-04", "2024-01-10")
    df = spark.createDataFrame([("2024-01-03 23:59:59",), ("2024-01-04 00:00:00",), ("2024-01-10 23:59:59",),
                                ("2024-01-11 00:00:00",)], "s string").selectExpr("cast(s as timestamp_ntz) ts")
    assert feed_window(df, "ts", "2024-01-10").count() == 2
    assert feed_window(df, "ts", "2024-01-10", as_of=dt.datetime(2024, 1, 10, 12)).count() == 1


def test_name_digits_are_ascii(spark):
    # Arabic-Indic digits are not taken as an official number (Java regex \d is ASCII)
    df = spark.createDataFrame([("٤٣٣ Eros (A898 PA)",)], "name string")
    r = df.select(X.official_number("name"), X.has_official_number("name")).first()
    assert tuple(r) == (None, False)
