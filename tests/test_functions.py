"""Scalar functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorewright import functions as fn
from scorewright.functions import sql as S


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(1, 16), (323, 80), (641, 80), (5, 0), (None, 3), (3, None), (0, 7)]
    return spark.createDataFrame(rows, "a int, b int")


def _both(df, col_expr, sql_expr):
    a = [r[0] for r in df.select(col_expr).collect()]
    b = [r[0] for r in df.select(F.expr(sql_expr)).collect()]
    assert a == b
    return a


def test_percent_rounds_half_away_exactly(pairs):
    # 1/16 = 0.0625 -> 6.3 ; 323/80 = 4.0375 -> 403.8 ; 641/80 = 8.0125 -> 801.3 (binary doubles get the last two wrong)
    out = _both(pairs, fn.percent_of("a", "b"), S.percent_of("a", "b"))
    assert out[:3] == [Decimal("6.3000000000"), Decimal("403.8000000000"), Decimal("801.3000000000")]
    assert out[3] is None and out[4] is None and out[5] is None  # zero or NULL on either side
    assert out[6] == Decimal("0E-10")


def test_format_percent_and_missing(pairs):
    out = _both(pairs, fn.format_percent(S.percent_of("a", "b")), S.format_percent(S.percent_of("a", "b")))
    assert out == ["6.3%", "403.8%", "801.3%", "-", "-", "-", "0.0%"]


def test_format_thousands(spark):
    df = spark.createDataFrame([(1234567.0,), (-1234.0,), (2.7,), (-2.7,), (None,)], "x double")
    out = _both(df, fn.format_thousands("x"), S.format_thousands("x"))
    assert out == ["1,234,567", "-1,234", "2", "-2", "-"]


def test_trunc_int_and_text(spark):
    df = spark.createDataFrame([(Decimal("2.7"),), (Decimal("-2.7"),)], "x decimal(20,10)")
    assert _both(df, fn.trunc_int("x"), S.trunc_int("x")) == [2, -2]
    assert _both(df, fn.to_text("x"), S.to_text("x")) == ["2.7000000000", "-2.7000000000"]


def test_round_half_away_on_decimals(spark):
    df = spark.createDataFrame([(Decimal("2.25"),), (Decimal("-2.25"),), (Decimal("2.5"),)], "x decimal(20,10)")
    assert _both(df, fn.round_half_away("x", 1), S.round_half_away("x", 1)) == [
        Decimal("2.3000000000"), Decimal("-2.3000000000"), Decimal("2.5000000000")]
    assert [r[0] for r in df.select(fn.to_decimal("x", 10, 1)).collect()] == [
        Decimal("2.3"), Decimal("-2.3"), Decimal("2.5")]


def test_concat_null_right_replace_coalesce(spark):
    df = spark.createDataFrame([("Customer#000000123", None, "NORTH REGION"), ("ab", "x", "SOUTH")],
                               "code string, first string, reg string")
    assert _both(df, fn.right("code", 6), S.right("code", 6)) == ["000123", "ab"]
    assert _both(df, fn.concat_null("first", S.lit(" "), "code"),
                 S.concat_null("first", S.lit(" "), "code")) == [None, "x ab"]
    assert _both(df, fn.replace("reg", " REGION"), S.replace("reg", " REGION")) == ["NORTH", "SOUTH"]
    assert _both(df, fn.if_null("first", S.lit("None")), S.if_null("first", S.lit("None"))) == ["None", "x"]


def test_month_label(spark):
    df = spark.createDataFrame([("2017-12-31",), (None,)], "d string").select(F.to_date("d").alias("d"))
    assert _both(df, fn.month_label("d"), S.month_label("d")) == ["December 2017", None]


def test_int_div_truncates_and_guards_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (3, 0), (None, 2)], "a long, b long")
    assert _both(df, fn.int_div("a", "b"), S.int_div("a", "b")) == [3, -3, None, None]


def test_safe_divide_type_is_decimal(spark, pairs):
    t = pairs.select(fn.safe_divide("a", "b").alias("q")).schema["q"].dataType
    assert t.simpleString() == "decimal(38,18)"


def test_flag_text(spark):
    df = spark.createDataFrame([("1",), ("0",), (None,)], "f string")
    assert _both(df, fn.flag_text("f"), S.flag_text("f")) == ["Y", "N", "N"]


def test_safe_divide_keeps_fractions(spark):
    df = spark.createDataFrame([(Decimal("1.5"), Decimal("2.50"), 2, 3.0)], "a decimal(5,1), b decimal(9,2), i int, x double")
    q = lambda a, b: df.select(fn.safe_divide(a, b).cast("decimal(20,10)")).first()[0]
    assert q("a", "b") == Decimal("0.6") and q("a", "i") == Decimal("0.75") and q("i", "b") == Decimal("0.8")
    assert q("a", "x") == Decimal("0.5")
    rows = spark.createDataFrame([(Decimal("1.4"), Decimal("2.4"))], "a decimal(5,1), b decimal(5,1)")
    assert rows.select(fn.percent_of("a", "b")).first()[0] == Decimal("58.3")
    assert rows.agg(fn.ratio_of_sums("a", "b")).first()[0] == Decimal("58.3")


def test_any_nonzero(spark):
    df = spark.createDataFrame([(0, None, 0), (None, None, 2), (None, None, None), (-1, 0, 0)], "a int, b int, c int")
    assert [r[0] for r in df.select(F.coalesce(fn.any_nonzero(["a", "b", "c"]), F.lit(False))).collect()] == [
        False, True, False, True]
