"""Known answers of the holiday rules and the date dimension."""

import datetime

import pytest
from pyspark.sql import functions as F

from starmart.functions import calendar

d = datetime.date


@pytest.fixture(scope="module")
def holidays(spark):
    years = spark.range(1995, 2036).select(F.col("id").cast("int").alias("year"))
    return {(r.year, r.holiday): r.full_date for r in calendar.bank_holidays(years).collect()}


def test_eight_weekdays_a_year(holidays):
    for year in range(1995, 2036):
        days = {v for (y, _), v in holidays.items() if y == year}
        assert len(days) == 8
        assert all(day.weekday() < 5 for day in days)


def test_substitutes(holidays):
    days = set(holidays.values())
    assert {d(2021, 12, 27), d(2021, 12, 28), d(2022, 1, 3)} <= days
    assert not {d(2021, 12, 25), d(2021, 12, 26), d(2022, 1, 1)} & days
    assert holidays[2020, "Boxing Day"] == d(2020, 12, 28)
    assert holidays[2022, "Christmas Day"] == d(2022, 12, 26)
    assert holidays[2022, "Boxing Day"] == d(2022, 12, 27)


def test_easter_against_dateutil(holidays):
    easter = pytest.importorskip("dateutil.easter").easter
    for year in range(1995, 2036):
        assert holidays[year, "Good Friday"] == easter(year) - datetime.timedelta(2)


@pytest.fixture(scope="module")
def days(spark):
    span = spark.sql("SELECT date'2019-01-01' AS lo, date'2022-12-31' AS hi")
    return {r.full_date: r for r in calendar.date_dimension(span).collect()}


def test_contiguous(days):
    assert len(days) == 1461
    assert days[d(2020, 2, 29)].date_id == 20200229


def test_retail_weeks(days):
    assert all(r.week_start_date.weekday() == 6 and r.week_end_date.weekday() == 5 for r in days.values())
    assert all(1 <= r.week_number <= 53 for r in days.values())
    first = days[d(2019, 1, 1)]  # the span starts inside a week of the previous retail year
    assert (first.retail_year, first.week_number) == (2018, 1)
    assert (days[d(2019, 1, 6)].retail_year, days[d(2019, 1, 6)].week_number) == (2019, 1)


def test_flags(days):
    assert [days[x].is_summer_holiday for x in (d(2019, 7, 25), d(2019, 8, 15), d(2019, 7, 1), d(2019, 9, 1))] == [
        True, True, False, False,
    ]
    assert days[d(2021, 12, 27)].is_bank_holiday and not days[d(2021, 12, 25)].is_bank_holiday
    assert days[d(2019, 12, 1)].calendar_season == "Winter"


def test_a_stray_date_lengthens_the_calendar(spark):
    span = spark.sql("SELECT DATE '1995-01-01' AS lo, DATE '9999-12-31' AS hi")
    days = calendar.date_dimension(span)
    assert days.select("full_date").count() == (datetime.date(9999, 12, 31) - datetime.date(1995, 1, 1)).days + 1



def test_no_dates_no_days(spark):
    nothing = spark.createDataFrame([], "d date")
    assert calendar.date_dimension(calendar.date_span((nothing, "d"))).isEmpty()
