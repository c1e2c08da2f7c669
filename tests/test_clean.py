"""SCA-1, SCA-10..18: cleaning rules against the golden cases."""

import math

import pytest
from pyspark.sql import functions as F

from churnlane.functions import clean

LENIENT = [
    (None, 0.0), ("1,5", 1.5), ("abc", 0.0), ("3,5", 3.5),
    ("", 0.0), (" ", 0.0), ("1,234.5", 0.0), ("1d", 0.0), ("0x1p3", 0.0),
    (" 3 ", 3.0), ("1e3", 1000.0), ("+5", 5.0), (".5", 0.5), ("5.", 5.0),
    ("\t7\n", 7.0), ("-2,25", -2.25), ("2F", 0.0),
    ("1_000", 1000.0), ("1_0,5", 10.5), ("1e1_0", 1e10), ("1__0", 0.0), ("_1", 0.0),
    ("\u00a03\u2003", 3.0), ("\uff13", 0.0),
]


def test_lenient_float_goldens(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(LENIENT)], "i int, v string")
    got = {r.i: r.x for r in df.select("i", clean.to_float("v").alias("x")).collect()}
    for i, (_, want) in enumerate(LENIENT):
        assert got[i] == pytest.approx(want), LENIENT[i]


def test_lenient_float_nan_inf(spark):
    df = spark.createDataFrame([("nan",), ("inf",), ("-Infinity",), ("-nan",), (" +INF ",)], "v string")
    got = [r.x for r in df.select(clean.to_float("v").alias("x")).collect()]
    assert math.isnan(got[0]) and got[1] == math.inf and got[2] == -math.inf
    assert math.isnan(got[3]) and got[4] == math.inf


def test_lenient_float_typed_numbers(spark):
    df = spark.createDataFrame([(None,), (3,)], "v int")
    got = [r.x for r in df.select(clean.to_float("v", df.schema["v"].dataType).alias("x")).collect()]
    assert got == [0.0, 3.0]


def test_strip_lower_is_whitespace_aware(spark):
    df = spark.createDataFrame([("\t a  ",), (" DIVORCÉ(E) ",)], "v string")
    got = [r.x for r in df.select(clean.strip_lower("v").alias("x")).collect()]
    assert got == ["a", "divorcé(e)"]


def test_blank_and_falsy(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "v string")
    rows = df.select(clean.is_blank("v").alias("b"),
                     clean.falsy_default("v", "John").alias("d")).collect()
    assert [r.b for r in rows] == [True, True, False, False]
    assert [r.d for r in rows] == ["John", "John", "  ", "x"]


def test_ratio_guard_and_lengths(spark):
    df = spark.createDataFrame([(2.0, 0.0), (3.0, 10.0), (1.0, None)], "n double, e double")
    got = [r.x for r in df.select(clean.safe_ratio("n", "e").alias("x")).collect()]
    assert got == [0.0, pytest.approx(0.3), 0.0]
    names = spark.createDataFrame([("ab",), ("abc",), ("a" * 80,), ("a" * 81,), (None,)], "u string")
    got = [r.ok for r in names.select(clean.length_between("u", 3, 80).alias("ok")).collect()]
    assert got == [False, True, True, False, False]


def test_digits_only_and_leading_number(spark):
    df = spark.createDataFrame([("12",), ("12a",), ("",), (" 4.5kg",)], "v string")
    rows = df.select(clean.digits_only("v").alias("d"), clean.leading_number("v").alias("n")).collect()
    assert [r.d for r in rows] == [True, False, False, False]
    assert [r.n for r in rows] == [12.0, 12.0, 0.0, 4.5]


def test_percent_texts(spark):
    df = spark.createDataFrame([(0.8,), (0.123456,)], "p double")
    rows = df.select(clean.percent_text("p").alias("a"),
                     clean.complement_percent_text("p").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [("80.00%", "20.00%"), ("12.35%", "87.65%")]


def test_like_escape():
    assert clean.like_escape("a%b_c\\") == "a\\%b\\_c\\\\"
    assert F is not None


def _python_rule(v):
    """The service's rule, stated with Python itself: blank -> 0, ',' -> '.'."""
    if v is None or v == "":
        return 0.0
    try:
        return float(v.replace(",", "."))
    except ValueError:
        return 0.0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_PIECES = st.sampled_from(list("0123456789") + ["+", "-", ".", ",", "e", "E", "_", " ", "\t",
                                                " ", " ", "nan", "inf", "Infinity",
                                                "x", "d", "f", "0x", "p"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(_PIECES, max_size=7).map("".join), min_size=20, max_size=20))
def test_lenient_float_matches_python_float(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = {r.i: r.x for r in df.select("i", clean.to_float("v").alias("x")).collect()}
    for i, t in enumerate(texts):
        want = _python_rule(t)
        if math.isnan(want):
            assert math.isnan(got[i]), t
        else:
            assert got[i] == want, (t, got[i], want)
