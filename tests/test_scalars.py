import datetime

import pytest
from pyspark.sql import functions as F

from assay.functions import dates as D
from assay.functions import text as X
from assay.functions.geo import haversine_km


def column(frame, values, kind="string"):
    return frame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_month_to_date_accepts_months_days_and_dates(frame):
    df = column(frame, ["2017-01", " 2017-01 ", "2017-01-15", "2017-01-15 00:00:00", "Jan 2017", "", None, "2017-13"])
    first, day = datetime.date(2017, 1, 1), datetime.date(2017, 1, 15)
    assert results(df, D.month_to_date("x")) == [first, first, day, day, None, None, None, None]
    dated = df.select("i", D.month_to_date("x").alias("x"))
    assert results(dated, D.month_to_date("x")) == [first, first, day, day, None, None, None, None]


def test_parse_date_gives_null_for_bad_text(frame):
    df = column(frame, ["2017-02-28", "2017-02-30", "2017-02", None])
    assert results(df, D.parse_date("x")) == [datetime.date(2017, 2, 28), None, None, None]


def test_year_and_month_parts(frame):
    df = column(frame, ["2017-03", "bad", None, ""])
    assert results(df, D.year_part("x")) == [2017, None, None, None]
    assert results(df, D.month_part("x")) == [3, None, None, None]


def test_quarter_of_every_month(frame):
    df = column(frame, [*range(1, 13), None], "int")
    assert results(df, D.quarter_of_month("x")) == [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3 + [None]


def test_quarters_back(frame):
    df = column(frame, [datetime.date(2020, 8, 31), datetime.date(2020, 1, 1)], "date")
    assert results(df, D.quarters_back("x", 6)) == [datetime.date(2020, 1, 1), datetime.date(2019, 7, 1)]


@pytest.mark.parametrize(
    "text, years",
    [("61 years 04 months", 61 + 4 / 12), ("62 years 01 month", 62 + 1 / 12), ("63 years", 63.0),
     ("61", None), ("", None), (None, None), ("5 Year 3 Month", 5.25)],
)
def test_years_months(frame, text, years):
    got = results(column(frame, [text]), X.years_months("x"))[0]
    assert got == (pytest.approx(years) if years is not None else None)


def test_bare_years_are_an_option(frame):
    assert results(column(frame, ["61", "x"]), X.years_months("x", bare_years=True)) == [61.0, None]


def test_range_midpoint(frame):
    df = column(frame, ["04 TO 06", "GROUND", "", None, "10 TO 12"])
    assert results(df, X.range_midpoint("x")) == [5.0, None, None, None, 11.0]


def test_guarded_cast_wants_a_plain_number(frame):
    df = column(frame, ["n/a", "1e5", "-3.5", "67", "", None, " 67", "99999999999"])
    assert results(df, X.guarded_cast("x", "double")) == [None, None, -3.5, 67.0, None, None, None, 99999999999.0]
    assert results(df, X.guarded_cast("x", "int")) == [None, None, None, 67, None, None, None, None]


def test_clean_number(frame):
    df = column(frame, ["10,591", " 7 ", "na", "NA", "", "None", "-", "abc", None, "-1.5"])
    assert results(df, X.clean_number("x")) == [10591.0, 7.0, None, None, None, None, None, None, None, -1.5]


def test_replacements_follow_each_other(frame):
    df = column(frame, ["a", "b", "c", "d", None])
    assert results(df, X.replace_values("x", {"a": "b", "b": "c"})) == ["c", "c", "c", "d", None]
    assert results(df, X.replace_values("x", {"b": "c", "a": "b"})) == ["b", "c", "c", "d", None]
    assert results(df, X.replace_values("x", {})) == ["a", "b", "c", "d", None]


def test_bin_by(frame):
    df = column(frame, [6.0, 6.1, 12.0, 13.0, None], "double")
    assert results(df, X.bin_by("x", [6, 12], ["low", "mid", "high"])) == ["low", "mid", "mid", "high", "unknown"]
    assert results(df, X.bin_by("x", [6, 12], ["low", "mid", "high"], "high"))[-1] == "high"


def test_quarter_parts(frame):
    df = column(frame, ["1990-Q1", "1990Q1", "2000-Q5x", "", None])
    year, quarter = X.quarter_parts("x")
    assert results(df, year) == [1990, None, None, None, None]
    assert results(df, quarter) == [1, None, None, None, None]


def test_concat_key_skips_nulls(frame):
    df = frame([(0, "12", None, "road")], "i int, a string, b string, c string")
    assert results(df, X.concat_key(["a", "b", "c"])) == ["12 road"]


def test_haversine_known_distances(frame):
    df = frame([(0, 0.0, 0.0, 0.0, 90.0), (1, 1.3, 103.8, 1.3, 103.8), (2, 0.0, 179.5, 0.0, -179.5)],
               "i int, a double, b double, c double, d double")
    got = results(df, haversine_km("a", "b", "c", "d"))
    assert got[0] == pytest.approx(6371 * 3.141592653589793 / 2)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(6371 * 3.141592653589793 / 180)


def test_month_label(frame):
    df = column(frame, [datetime.date(2020, 8, 31)], "date")
    assert results(df, D.month_label("x")) == ["2020-08"]


def test_remaining_and_elapsed(frame):
    df = frame([(0, 2017, 1980), (1, 2017, None)], "i int, y int, s int")
    assert results(df, D.remaining_term("y", "s")) == [62.0, None]
    assert results(df, D.elapsed_years("y", "s")) == [37.0, None]
    assert results(df, F.col("y")) == [2017, 2017]
