from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import values
from tidemark.functions import scalars as X
from tidemark.operators.calendar import calendar, date_spine, one_row


def test_time_units(frame):
    df = frame("t double, u int", [(90.0, 1), (90.0, 2), (90.0, None)])
    assert sorted(r[0] for r in df.select(X.to_hours("t", "u")).collect()) == [1.5, 90.0, 90.0]


def test_description_is_null_with_a_null_part(frame):
    df = frame("a string, b string", [("x", "y"), ("x", None)])
    assert values(df.select(X.describe("a", "b"))) == [("x , y",), (None,)]


def test_products_multiply_left_to_right(frame):
    df = frame("a double, b double, c double", [(0.1, 0.7, 3.3)])
    assert df.select(X.amount("a", "b", "c")).first()[0] == 0.1 * 0.7 * 3.3


def test_conform_cuts_toward_zero_and_drops_time(frame):
    df = frame("n double, d timestamp_ntz", [(2.75, datetime(2020, 1, 2, 3)), (-2.75, None)])
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.IntegerType())])
    assert values(X.conform(df, schema)) == [(None, -2), (date(2020, 1, 2), 2)]


def test_iso_week_beside_calendar_year(frame):
    days = frame("day date", [(date(2016, 1, 1),), (date(2020, 12, 31),), (date(2021, 1, 3),)])
    assert values(calendar(days).select("Year", "Week")) == [(2016, 53), (2020, 53), (2021, 53)]


def test_semester(frame):
    days = frame("day date", [(date(2021, 6, 30),), (date(2021, 7, 1),)])
    assert values(calendar(days).select("Semester")) == [(1,), (2,)]


def test_every_day_of_seventy_years_as_in_python(spark):
    spine = date_spine(one_row(spark), date(1970, 1, 1), date(2039, 12, 31))
    rows = spine.select("day", X.weekday("day"), X.iso_week("day"), X.semester("day")).collect()
    assert len(rows) == 25567
    for day, weekday, week, semester in rows:
        assert (weekday, week, semester) == (day.weekday(), day.isocalendar()[1], (day.month - 1) // 6 + 1)


def test_spine_ends_today_by_default_and_may_be_empty(spark):
    last = date_spine(one_row(spark), date(2020, 1, 1)).agg(F.max("day") == F.current_date()).first()[0]
    assert last
    assert date_spine(one_row(spark), date(2020, 1, 2), date(2020, 1, 1)).count() == 0


def test_by_weekday(frame):
    df = frame("d date, a int, b int, c int", [(date(2024, 1, 1), 1, 2, 3), (date(2024, 1, 7), 1, 2, 3)])
    assert values(df.select(X.by_weekday("d", ["a", "b", "c", "a", "b", "c", "b"]))) == [(1,), (2,)]


def test_month_number(frame):
    df = frame("d date", [(date(2016, 1, 31),), (date(2015, 12, 1),), (None,)])
    assert values(df.select(X.month_number("d"))) == [(0,), (2015 * 12 + 12,), (2016 * 12 + 1,)]
