"""England & Wales bank holidays and the date dimension, as frames derived from a date span."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.text import col


def easter_sunday(year: Column | str) -> Column:
    """Gregorian Easter from integer arithmetic on the year."""
    y = col(year).cast("int")

    def div(n: Column, d: int) -> Column:
        return F.floor(n / d).cast("int")

    golden, century, within = y % 19, div(y, 100), y % 100
    epact = (19 * golden + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    to_sunday = (32 + 2 * (century % 4) + 2 * div(within, 4) - epact - within % 4) % 7
    late = div(golden + 11 * epact + 22 * to_sunday, 451)
    n = epact + to_sunday - 7 * late + 114
    return F.make_date(y, div(n, 31), n % 31 + 1)


def nth_monday(year: Column | str, month: int, n: int = 1) -> Column:
    first = F.make_date(col(year), F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "MON"), 7 * (n - 1))


def last_monday(year: Column | str, month: int) -> Column:
    end = F.last_day(F.make_date(col(year), F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(end, 7), "MON")


def new_year_observed(year: Column | str) -> Column:
    """1 January, moved to Monday from a weekend."""
    day = F.make_date(col(year), F.lit(1), F.lit(1))
    return F.date_add(day, F.when(F.weekday(day) >= 5, 7 - F.weekday(day)).otherwise(0))


def christmas_observed(year: Column | str) -> Column:
    """25 December, moved to Monday from a weekend."""
    day = F.make_date(col(year), F.lit(12), F.lit(25))
    return F.date_add(day, F.when(F.weekday(day) >= 5, 7 - F.weekday(day)).otherwise(0))


def boxing_observed(year: Column | str) -> Column:
    """26 December; the weekday of Christmas decides how far it has to give way."""
    day = F.make_date(col(year), F.lit(12), F.lit(25))
    shift = F.when(F.weekday(day).isin(4, 5), 3).when(F.weekday(day) == 6, 2).otherwise(1)
    return F.date_add(day, shift)


def bank_holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """One row per holiday, eight for each year of ``years``: (year, holiday, full_date)."""
    rules = {
        "New Year's Day": new_year_observed(year),
        "Good Friday": F.date_sub(easter_sunday(year), 2),
        "Easter Monday": F.date_add(easter_sunday(year), 1),
        "Early May bank holiday": nth_monday(year, 5),
        "Spring bank holiday": last_monday(year, 5),
        "Summer bank holiday": last_monday(year, 8),
        "Christmas Day": christmas_observed(year),
        "Boxing Day": boxing_observed(year),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("holiday"), v.alias("full_date")) for k, v in rules.items()])
    return years.select(F.col(year).alias("year"), F.explode(rows).alias("h")).select(
        "year", "h.holiday", "h.full_date"
    )


def date_span(*sources: tuple[DataFrame, str] | tuple[DataFrame, str, str]) -> DataFrame:
    """One row (lo, hi) over date columns of several tables: (table, column, ...).

    Each table is scanned once and reduced to one row before the union. Tables
    without a date drop out, and NULL dates are skipped.
    """
    ends = []
    for df, *columns in sources:
        pairs = [F.struct(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")) for c in columns]
        ends.append(df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs")))
    return reduce(DataFrame.unionByName, ends).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def date_dimension(span: DataFrame) -> DataFrame:
    """One row per calendar day between ``lo`` and ``hi``, 17 columns.

    No span, no days. A stray date lengthens the calendar and nothing else: callers leave
    it to Spark how the calendar is joined.
    """
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    years = span.select(F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))
    holidays = bank_holidays(years).select("full_date", F.lit(True).alias("is_bank_holiday"))
    d = "full_date"
    weeks = Window.partitionBy("retail_year").orderBy("week_start_date")
    return (
        days.withColumn("week_start_date", dates.retail_week_start(d))
        .withColumn("retail_year", F.year("week_start_date"))
        .withColumn("week_number", F.dense_rank().over(weeks))
        .join(F.broadcast(holidays), "full_date", "left")
        .select(
            dates.date_key(d).alias("date_id"),
            d,
            F.day(d).alias("day"),
            F.month(d).alias("month"),
            dates.month_name(d).alias("month_name"),
            F.quarter(d).alias("quarter"),
            F.year(d).alias("year"),
            F.weekday(d).alias("day_of_week"),
            dates.day_name(d).alias("day_name"),
            dates.is_weekend(d).alias("is_weekend"),
            dates.calendar_season(F.month(d)).alias("calendar_season"),
            "week_start_date",
            F.date_add("week_start_date", 6).alias("week_end_date"),
            "week_number",
            "retail_year",
            F.coalesce("is_bank_holiday", F.lit(False)).alias("is_bank_holiday"),
            dates.is_summer_holiday(d).alias("is_summer_holiday"),
        )
    )
