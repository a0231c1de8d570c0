from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from filingloom.functions import text as t


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "c string").select(fn(F.col("c"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("1/5/2016 12:00:00 AM", datetime(2016, 1, 5)),
    ("01/05/2016 12:00:00 pm", datetime(2016, 1, 5, 12)),
    (" 1/5/2016 1:02:03 PM ", datetime(2016, 1, 5, 13, 2, 3)),
    ("13/40/2016 1:00:00 AM", None),
    ("1/5/2016", None),
    ("", None),
    (None, None),
])
def test_filing_timestamp(spark, raw, expected):
    assert one(spark, raw, t.parse_filing_ts) == expected


def test_filing_date(spark):
    assert one(spark, "9/1/2015 11:59:59 PM", t.parse_filing_date) == date(2015, 9, 1)


@pytest.mark.parametrize("year, session", [(2015, 2015), (2016, 2015), (2017, 2017), (2000, 1999)])
def test_session_year(spark, year, session):
    df = spark.createDataFrame([(f"3/4/{year} 1:00:00 AM",)], "c string")
    assert df.select(t.session_year(t.parse_filing_ts(F.col("c")))).first()[0] == session


@pytest.mark.parametrize("raw, expected", [("\t a b \r\n", "A B"), ("\xa0x\x1f", "X"), ("", ""), (None, None)])
def test_clean(spark, raw, expected):
    assert one(spark, raw, t.clean) == expected


@pytest.mark.parametrize("raw, expected", [("10", 10), (" 9", 9), ("1x", 1), ("x", None), ("", None), (None, None)])
def test_amendment_number(spark, raw, expected):
    assert one(spark, raw, t.amendment_no) == expected


@pytest.mark.parametrize("city, state, expected", [
    ("SACRAMENTO, CA", "NV", ("SACRAMENTO", "CA")), ("A, B, C", "NV", ("A, B, C", "NV")),
    ("SACRAMENTO", "CA", ("SACRAMENTO", "CA")), (None, "CA", (None, "CA")),
])
def test_city_and_state(spark, city, state, expected):
    df = spark.createDataFrame([(city, state)], "c string, s string")
    parts = t.split_city_state(F.col("c"), F.col("s"))
    assert tuple(df.select(*parts.values()).first()) == expected


def split(spark, mode, *values):
    df = spark.createDataFrame([values], "f string, m string, l string, s string")
    return tuple(df.select(*t.split_name(*[F.col(c) for c in "fmls"], mode).values()).first())


@pytest.mark.parametrize("values, expected", [
    (("Mary Ann", None, "smith", ""), ("MARY", "ANN", "SMITH", None)),
    ((None, None, "Smith John", None), ("SMITH", None, "SMITH JOHN", None)),
    (("", None, " Jo ", "III"), ("JO", None, "JO", "III")),
    ((None, None, None, None), (None, None, None, None)),
])
def test_split_always(spark, values, expected):
    assert split(spark, "always", *values) == expected


@pytest.mark.parametrize("values, expected", [
    (("Mary Ann", "", "Smith", ""), ("MARY ANN", None, "SMITH", None)),
    (("Mary Q.", "", "Smith", ""), ("MARY", "Q.", "SMITH", None)),
    (("Mary", None, "Smith Jr.", ""), ("MARY", None, "SMITH", "JR.")),
    (("Mary Q.", " ", "Smith B.", "II"), ("MARY Q.", "B.", "SMITH", "II")),
    (("Mary", "Q.", "Smith Jr.", ""), ("MARY", "Q.", "SMITH JR.", None)),
    (("R.", None, "Leslie", ""), ("R.", None, "LESLIE", None)),
    (("Mary Sr.", None, None, ""), ("MARY", None, None, "SR.")),
    ((None, None, None, None), (None, None, None, None)),
])
def test_split_dotted(spark, values, expected):
    assert split(spark, "dotted", *values) == expected


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        split(spark, "other", None, None, None, None)


def test_concat_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(t.concat_names(F.col("x"), F.col("y"))).collect()] == [None, "ab"]


@pytest.mark.parametrize("raw, expected", [("Q.", "Q"), ("Q..", "Q"), ("Quincy", "Quincy"), (".", ""), ("", None)])
def test_middle_initial(spark, raw, expected):
    assert one(spark, raw, t.middle_initial) == expected
