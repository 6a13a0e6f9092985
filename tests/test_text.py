import datetime as dt

import pytest

from ledgerloom.functions import text

SENTINEL = dt.date(1900, 1, 1)


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def test_missing_tokens(spark):
    got = values(spark, ["", "   ", "null", "NULL", " NULL ", None, "Null", " a "], text.blank_to_null("v"))
    assert got == [None, None, None, None, None, None, "Null", " a "]


def test_ident(spark):
    assert values(spark, [" c01 ", "  ", "B2"], text.ident("v")) == ["C01", None, "B2"]


def test_label(spark):
    got = values(spark, [" fixed DEPOSIT", "", "o'neil smith-jones"], text.label("v", True, "Unknown"))
    assert got == ["Fixed Deposit", "Unknown", "O'neil Smith-jones"]
    assert values(spark, [" mainST ", None], text.label("v", False, "Unknown Branch")) == ["mainST", "Unknown Branch"]


def test_phone_digits_stay_integers(spark):
    got = values(spark, ["+1 (555) 01", "n/a", "9" * 25, None], text.digits("v"))
    assert got == [155501, None, None, None]


@pytest.mark.parametrize(
    "raw, number",
    [
        ("$1,234.50", 1234.5),
        ("-250.5", -250.5),
        ("12345678", 12345678.0),
        ("1.0E7", 1.0e7),
        ("1.0E-4", 1.0e-4),
        (".5", 0.5),
        ("EUR -3", -3.0),
        ("none", None),
        ("1.2.3", None),
        ("", None),
    ],
)
def test_money(spark, raw, number):
    assert values(spark, [raw], text.money("v")) == [number]


def test_day_is_strict(spark):
    got = values(spark, ["2024-02-29", "2023-02-29", "2024-1-5", "", "null", None, "1990-13-45"], text.day("v"))
    assert got == [dt.date(2024, 2, 29)] + [SENTINEL] * 6
