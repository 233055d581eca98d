import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitpanel.functions import (add_months_6, fye_date, header_date_text, lenient_double,
                                parse_date, round_half_up, strict_double, year_bin)

D = dt.date


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_add_months_clamps(spark):
    got = one(spark, add_months_6("d"), [(D(2020, 8, 31),), (D(2020, 2, 29),), (D(2019, 2, 28),)], "d date")
    assert got == [D(2021, 2, 28), D(2020, 8, 29), D(2019, 8, 28)]


def test_lenient_number(spark):
    assert one(spark, lenient_double("s"), [("x",), (" 1.5",), (None,)], "s string") == [None, 1.5, None]


def test_strict_number_raises(spark):
    with pytest.raises(Exception):
        one(spark, strict_double("s"), [("x",)], "s string")


def test_lenient_and_strict_dates(spark):
    rows = [("20201345",), ("20201231",)]
    assert one(spark, parse_date("s", "yyyyMMdd", strict=False), rows, "s string") == [None, D(2020, 12, 31)]
    with pytest.raises(Exception):
        one(spark, parse_date("s", "yyyyMMdd", strict=True), rows, "s string")


def test_header_extract(spark):
    got = one(spark, header_date_text("h"), [("01/02/2003_duplicated_0",), ("abc",)], "h string")
    assert got == ["01/02/2003", None]


def test_fye_marker(spark):
    assert one(spark, fye_date("m"), [('"d20041231"',), (None,)], "m string") == [D(2004, 12, 31), None]


def test_round_half_up(spark):
    got = one(spark, round_half_up("v", 1), [(2.25,), (-2.25,), (0.15,), (0.35,)], "v double")
    assert got == [2.3, -2.3, 0.2, 0.4]


def test_year_bins(spark):
    years = [1969, 1970, 1989, 1990, 1994, 2015, 2018, 2019, 2029, 2030, None]
    got = one(spark, year_bin("y"), [(y,) for y in years], "y int")
    assert got == [None, "Other", "Other", "1990–1994", "1990–1994", "2015–2018", "2015–2018",
                   "Other", "Other", None, None]


def test_bins_frame_size(spark):
    from pitpanel.functions import year_bins_frame
    assert year_bins_frame(spark).count() == 60


def test_java_suffixes_are_not_numbers(spark):
    from pitpanel.functions.numeric import whole_number
    assert one(spark, lenient_double("s"), [("12d",), ("1f",), ("-1.5e3",), (".5",)], "s string") == [None, None, -1500.0, 0.5]
    assert one(spark, whole_number("s"), [("2003.0",), ("2003",), ("1.5",), ("x",)], "s string") == [2003, 2003, None, None]
