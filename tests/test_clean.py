"""Cleaning functions: literal edge cases (FIXTURES 1-7) and helpers."""

import datetime as dt

from pyspark.sql import functions as F

from lakefold.functions import clean


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_keyword_first_run(spark):
    df = one_col(spark, ['"alpha beta"', "!!", None, '"한국 뉴스"'])
    assert col_values(df, clean.keyword("x")) == ["alpha", "", None, "한국"]


def test_dotted_date_strict(spark):
    df = one_col(spark, ["2022.11.02", "2022.13.01", "2022.1.1", None])
    assert col_values(df, clean.parse_date("x")) == [dt.date(2022, 11, 2), None, None, None]


def test_hour24_reference_and_roll(spark):
    df = one_col(spark, ["2022-11-02 24:00", "2022-11-02 13:00", "2022-11-02 24:30"])
    ref = col_values(df, clean.hour24_timestamp("x").cast("timestamp_ntz"))
    roll = col_values(df, clean.hour24_timestamp("x", roll_day=True).cast("timestamp_ntz"))
    assert ref == [dt.datetime(2022, 11, 2, 0, 0), dt.datetime(2022, 11, 2, 13, 0), None]
    assert roll == [dt.datetime(2022, 11, 3, 0, 0), dt.datetime(2022, 11, 2, 13, 0), None]


def test_float_cast(spark):
    df = one_col(spark, ["0.4", "-", "", None])
    got = col_values(df, clean.to_float("x"))
    assert abs(got[0] - 0.4) < 1e-6 and got[1:] == [None, None, None]


def test_int_cast_truncates(spark):
    df = one_col(spark, ["5", " 5 ", "12.7", "-12.7", "99999999999", "-"])
    assert col_values(df, clean.to_int("x")) == [5, 5, 12, -12, None, None]


def test_month_period(spark):
    df = one_col(spark, ["202211", None, "202213"])
    assert col_values(df, clean.month_period("x")) == [dt.date(2022, 11, 1), None, None]


def test_code_prefix_and_length(spark):
    df = one_col(spark, ["11010", "2"])
    assert col_values(df, clean.code_prefix("x")) == ["11", "2"]
    assert col_values(df, clean.code_length("x")) == [5, 1]


def test_url_term_form_encoding(spark):
    df = one_col(spark, ["a b", "x&y=z", '"a~b*c"/é'])
    # same text as Python's urllib.parse.urlencode value
    assert col_values(df, clean.url_term("x")) == ["a+b", "x%26y%3Dz", "%22a~b%2Ac%22%2F%C3%A9"]


def test_node_text(spark):
    df = one_col(spark, ["  <b>Hi</b> <i>there</i> "])
    assert col_values(df, clean.node_text("x")) == ["Hi there"]


def test_series(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), dt.date(2024, 2, 2))], "a date, b date")
    days = df.select(F.explode(clean.day_series("a", "b"))).collect()
    months = df.select(F.explode(clean.month_series("a", "b"))).collect()
    assert len(days) == 4
    assert [r[0] for r in months] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_binary_text_and_day_format(spark):
    df = spark.createDataFrame([(bytearray(b"hello"), dt.date(2024, 1, 5))], "b binary, d date")
    row = df.select(clean.binary_text("b"), clean.format_day("d", "yyyy.MM.dd"), clean.format_day("d", "yyyyMM")).first()
    assert tuple(row) == ("hello", "2024.01.05", "202401")
