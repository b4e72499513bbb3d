"""Period-over-period steps on already aggregated series, and event gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.numbers import ratio


def prior_period(df: DataFrame, period: Sequence[str], value: str, prior: str) -> DataFrame:
    """Value of the previous period present in the series.

    The window has no partition, so the frame must be one row per period.
    """
    return df.withColumn(prior, F.lag(value).over(Window.orderBy(*period)))


def growth_pct(value: Column, prior: Column, places: int = 1) -> Column:
    """Change in percent; NULL without a prior value or when it is zero."""
    return F.round(100 * ratio(value - prior, prior), places)


def year_to_date(df: DataFrame, year: str, day: str, value: str, name: str) -> DataFrame:
    """Running sum inside each year over one row per day (at most 366 rows a window)."""
    w = Window.partitionBy(year).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def same_period_last_year(
    df: DataFrame, year: str, value: str, name: str, period: Sequence[str] = (), by: Sequence[str] = ()
) -> DataFrame:
    """Value of the same period one year before; robust to missing periods, unlike a fixed lag."""
    keys = [*period, *by]
    past = df.select(
        (F.col(year) + 1).alias("_year"), *[F.col(c).alias(f"_{c}") for c in keys], F.col(value).alias(name)
    )
    on = [F.col(year) == F.col("_year"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]]
    return df.join(past, on, "left").drop("_year", *[f"_{c}" for c in keys])


def over_all(value: Column) -> Column:
    """An aggregate over all rows of a report, next to each row.

    The window has no partition: for frames with one row per entry of a code
    list (regions, channels, statuses), where it saves a second pass over the
    fact that a scalar subquery would need.
    """
    return value.over(Window.partitionBy())


def share_of_total(df: DataFrame, value: str, name: str, places: int | None = None) -> DataFrame:
    """Each row's share of the grand total of a code-list frame."""
    share = ratio(F.col(value), over_all(F.sum(value)))
    return df.withColumn(name, F.round(share, places) if places is not None else share)


def event_days(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, day, n): how often each key occurs per day.

    This is the skew guard of the event-gap reports: a key with a third of all
    rows shrinks, map-side, to one row per calendar day it was active.
    """
    return df.groupBy(key, day).agg(F.count(F.lit(1)).alias("n"))


def next_day(days: DataFrame, key: str, day: str, name: str) -> DataFrame:
    """Next active day of the key; a window holds at most one row per calendar day."""
    return days.withColumn(name, F.lead(day).over(Window.partitionBy(key).orderBy(day)))
