"""Date rules and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.text import col


def date_key(c: Column | str) -> Column:
    """Calendar day as the integer YYYYMMDD."""
    d = col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def key_year(c: Column | str) -> Column:
    return F.floor(col(c) / 10000).cast("int")


def key_month(c: Column | str) -> Column:
    return (F.floor(col(c) / 100) % 100).cast("int")


def key_date(c: Column | str) -> Column:
    """Back from YYYYMMDD to a date, without a calendar join."""
    k = col(c)
    return F.make_date(key_year(k), key_month(k), (k % 100).cast("int"))


def tolerant_date(c: Column | str) -> Column:
    return col(c).cast("string").try_cast("date")


def tolerant_timestamp(c: Column | str) -> Column:
    """Unreadable text becomes NULL instead of failing the job."""
    return col(c).cast("string").try_cast("timestamp_ntz")


def month_start(c: Column | str) -> Column:
    """``2024-03`` to the first of that month."""
    return F.concat(col(c).cast("string"), F.lit("-01")).try_cast("date")


def year_month(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def month_name(c: Column | str) -> Column:
    return F.date_format(col(c), "MMMM")


def day_name(c: Column | str) -> Column:
    return F.date_format(col(c), "EEEE")


def is_weekend(c: Column | str) -> Column:
    return F.weekday(col(c)) >= 5


def retail_week_start(c: Column | str) -> Column:
    """The Sunday on or before the day."""
    d = col(c)
    return F.date_sub(d, (F.weekday(d) + 1) % 7)


def calendar_season(month: Column | str) -> Column:
    """Meteorological season of a month number."""
    m = col(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .when(m.isin(9, 10, 11), "Autumn")
    )


def trading_season(month: Column | str) -> Column:
    """November to March trades as winter."""
    return F.when(col(month).isin(11, 12, 1, 2, 3), "Winter season").otherwise("Summer season")


def is_summer_holiday(c: Column | str) -> Column:
    """School summer holidays: 20 July to 31 August."""
    d = col(c)
    return ((F.month(d) == 7) & (F.day(d) >= 20)) | (F.month(d) == 8)


def lead_time_bucket(days: Column | str) -> Column:
    # The report labels.
    d = col(days)
    return (
        F.when(d <= 7, "0-7 days").when(d <= 30, "8-30 days").when(d <= 90, "31-90 days").otherwise("90+ days")
    )


def experience_band(years: Column | str) -> Column:
    # The report labels.
    y = col(years)
    return (
        F.when(y < 5, "Junior (<5 yrs)").when(y < 15, "Experienced (5-15 yrs)").otherwise("Veteran (15+ yrs)")
    )
