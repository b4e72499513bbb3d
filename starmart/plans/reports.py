"""Reporting views, analytical queries and parameterised reports over the star schema.

Common pattern: facts are aggregated on their integer keys first, dimensions
are joined to the (much smaller) result. A key with a third of all bookings
therefore leaves each map task as a single row, and joins move aggregates, not
facts. Year and month come from the date key itself; the calendar is joined
only for attributes a date does not carry.
"""

from __future__ import annotations

import math
from collections import ChainMap
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.numbers import MONEY, avg_exact, count_rows, rate, sum_if
from starmart.operators import ranking, series
from starmart.operators.lookup import lookup
from starmart.plans import snapshots
from starmart.schemas import DATE_YEAR, PARTITION_DATE
from starmart.session import releasing, shared_path, written

Star = Mapping[str, DataFrame]
#: Bookings that are made wide at a time where they are stored; each of them takes a few hundred bytes of shuffle files.
SLICE_ROWS = 1 << 24


def _is(status: str) -> Column:
    return F.col("status") == status


def _completed() -> Column:
    """Bookings that count as a trip: confirmed or amended."""
    return F.col("status").isin("confirmed", "amended")


def _totals() -> list[Column]:
    """Additive booking totals; sums of these are exact at any coarser grain."""
    return [
        F.count("booking_id").alias("bookings"),
        F.count_if(_is("confirmed")).alias("confirmed"),
        F.count_if(_is("cancelled")).alias("cancellations"),
        sum_if(_is("confirmed"), F.col("total_price")).alias("revenue"),
    ]


def _resum(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _rating(column: str) -> list[Column]:
    """Sum and count of a rating, to be averaged at the final grain."""
    return [F.sum(column).alias(f"{column}_sum"), F.count(column).alias(f"{column}_n")]


def _avg_rating(column: str, name: str) -> Column:
    return rate(F.col(f"{column}_sum"), F.col(f"{column}_n"), 2).alias(name)


def in_years(df: DataFrame, key: str, years: Sequence[int]) -> DataFrame:
    """Rows whose date key lies in the years, as key ranges.

    A fact stored by year of that key is also filtered on the folder column, so
    other years are not even listed.
    """
    ranges = [F.col(key).between(y * 10000 + 101, y * 10000 + 1231) for y in years]
    df = df.where(reduce(Column.__or__, ranges))
    if DATE_YEAR in df.columns and key in PARTITION_DATE.values():
        df = df.where(F.col(DATE_YEAR).isin(*years))
    return df


# ------------------------------------------------------------------ views


def bookings_enriched(star: Star) -> DataFrame:
    """One wide row per booking: dates, customer, route, region, guide, channel."""
    b = star["FactBookings"]
    d = star["DimDate"]
    tour = d.select(
        F.col("date_id").alias("tour_date_id"),
        F.col("full_date").alias("tour_date"),
        F.col("year").alias("tour_year"),
        F.col("month").alias("tour_month"),
        F.col("month_name").alias("tour_month_name"),
        F.col("quarter").alias("tour_quarter"),
        F.col("is_weekend").alias("tour_is_weekend"),
    )
    created = d.select(F.col("date_id").alias("created_date_id"), F.col("full_date").alias("created_date"))
    route = star["DimRoute"].select("route_id", F.col("name").alias("route_name"), "difficulty", "distance_km")
    region = star["DimRegion"].select("region_id", F.col("name").alias("region_name"))
    guide = star["DimGuide"].select("guide_id", F.col("full_name").alias("guide_name"))
    channel = star["DimMarketingChannel"].select("channel_id", F.col("channel_name").alias("marketing_channel"))
    customer = star["DimCustomer"].select("customer_id", "contact_name", "contact_email")
    return (
        b.join(tour, "tour_date_id")
        .join(created, "created_date_id")
        .join(customer, "customer_id")
        .join(route, "route_id")
        .join(region, "region_id")
        .join(guide, "guide_id", "left")
        .join(channel, "channel_id", "left")
        .select(
            "booking_id", "booking_reference", "status", "party_size", "total_price", "lead_time_days", "season",
            "tour_date", "tour_year", "tour_month", "tour_month_name", "tour_quarter", "tour_is_weekend",
            "created_date", "customer_id", "contact_name", "contact_email", "route_id", "route_name", "difficulty",
            "distance_km", "region_id", "region_name", "guide_id", "guide_name", "marketing_channel",
        )
    )


def stored_enriched(star: Star) -> DataFrame:
    """``bookings_enriched`` of a star that is derived as it is read, stored slice by slice if there are many bookings.

    Calendar and guides are stored first: Spark then knows how small they are, and bookings do not shuffle to meet
    them. The shuffle files of a slice go before the next one begins.
    """
    known = {name: written(star[name], name) for name in ("DimDate", "DimGuide")}
    b = star["FactBookings"]
    count = written(b.agg(count_rows().alias("n")), "count").first()["n"]
    slices = math.ceil(count / SLICE_ROWS)
    if slices < 2:
        return bookings_enriched(ChainMap(known, star))
    path = shared_path(b.sparkSession, "bookings-enriched")
    for k in range(slices):
        own = F.pmod(F.shiftright(F.xxhash64("booking_id"), 40), F.lit(slices)) == k
        wide = bookings_enriched(ChainMap({"FactBookings": b.where(own)}, known, star))
        with releasing(b.sparkSession):
            wide.write.mode("append").parquet(path, compression="zstd")
    return b.sparkSession.read.parquet(path)


def monthly_totals(star: Star) -> DataFrame:
    """(year, month, month_name, totals): one row per tour month."""
    per_month = star["FactBookings"].groupBy(F.floor(F.col("tour_date_id") / 100).alias("ym")).agg(*_totals())
    first = F.make_date(F.floor(F.col("ym") / 100).cast("int"), (F.col("ym") % 100).cast("int"), F.lit(1))
    return per_month.select(
        F.year(first).alias("year"),
        F.month(first).alias("month"),
        dates.month_name(first).alias("month_name"),
        "bookings",
        "confirmed",
        "cancellations",
        "revenue",
    )


def monthly_revenue(star: Star) -> DataFrame:
    return monthly_totals(star).select(
        F.col("year").alias("tour_year"),
        F.col("month").alias("tour_month"),
        F.col("month_name").alias("tour_month_name"),
        "bookings",
        "revenue",
        "cancellations",
        rate(F.col("cancellations"), F.col("bookings")).alias("cancellation_rate"),
    )


def route_performance(star: Star) -> DataFrame:
    """Routes with bookings. Reviews carry the route key, so no fact is joined to a fact."""
    totals = star["FactBookings"].groupBy("route_id").agg(*_totals())
    ratings = star["FactReviews"].groupBy("route_id").agg(*_rating("overall_rating"))
    routes = star["DimRoute"].select("route_id", F.col("name").alias("route_name"), "region_id", "difficulty")
    regions = star["DimRegion"].select("region_id", F.col("name").alias("region_name"))
    return (
        totals.join(ratings, "route_id", "left")
        .join(routes, "route_id")
        .join(regions, "region_id")
        .select(
            "route_id",
            "route_name",
            "region_name",
            "difficulty",
            "bookings",
            "revenue",
            rate(F.col("cancellations"), F.col("bookings")).alias("cancellation_rate"),
            _avg_rating("overall_rating", "avg_overall_rating"),
        )
    )


def guide_performance(star: Star) -> DataFrame:
    """Every guide, also those without bookings (0 revenue, empty rate)."""
    totals = star["FactBookings"].groupBy("guide_id").agg(*_totals())
    ratings = (
        star["FactReviews"].groupBy("guide_id").agg(*_rating("guide_rating"), *_rating("safety_rating"))
    )
    return (
        star["DimGuide"]
        .join(totals, "guide_id", "left")
        .join(ratings, "guide_id", "left")
        .select(
            "guide_id",
            "full_name",
            "employment_type",
            "day_rate_gbp",
            F.coalesce("bookings", F.lit(0)).alias("bookings"),
            F.coalesce("revenue", F.lit(0).cast(MONEY)).alias("revenue"),
            rate(F.col("cancellations"), F.col("bookings")).alias("cancellation_rate"),
            _avg_rating("guide_rating", "avg_guide_rating"),
            _avg_rating("safety_rating", "avg_safety_rating"),
        )
    )


def customer_summary(star: Star) -> DataFrame:
    """Customers with bookings: count, lifetime value, first and last tour, repeat flag (any status)."""
    totals = (
        star["FactBookings"]
        .groupBy("customer_id")
        .agg(*_totals(), F.min("tour_date_id").alias("first"), F.max("tour_date_id").alias("last"))
    )
    return star["DimCustomer"].join(totals, "customer_id").select(
        "customer_id",
        "contact_name",
        "contact_email",
        F.col("bookings").alias("total_bookings"),
        F.col("revenue").alias("lifetime_value"),
        dates.key_date("first").alias("first_booking_date"),
        dates.key_date("last").alias("last_booking_date"),
        F.when(F.col("bookings") > 1, 1).otherwise(0).alias("is_repeat_customer"),
    )


# Fixed value: rain above this many millimetres counts as bad weather.
HEAVY_RAIN_MM = 15


def bad_weather() -> Column:
    return F.col("storm_warning") | (F.col("rain_mm") > HEAVY_RAIN_MM)


def weather_flagged_cancellations(star: Star) -> DataFrame:
    """Cancelled bookings with the weather of their region and day."""
    b = star["FactBookings"].where(_is("cancelled"))
    weather = star["FactWeather"].select(
        "region_id", F.col("date_id").alias("tour_date_id"), "storm_warning", "rain_mm"
    )
    routes = star["DimRoute"].select("route_id", F.col("name").alias("route_name"))
    regions = star["DimRegion"].select("region_id", F.col("name").alias("region_name"))
    return (
        b.join(weather, ["region_id", "tour_date_id"])
        .join(routes, "route_id")
        .join(regions, "region_id")
        .select(
            "booking_id",
            "route_name",
            "region_name",
            dates.key_date("tour_date_id").alias("tour_date"),
            "storm_warning",
            "rain_mm",
            F.when(bad_weather(), 1).otherwise(0).alias("weather_flagged"),
        )
    )


def _marketing_by_month(star: Star) -> DataFrame:
    """Marketing sums per channel and month."""
    return star["FactMarketing"].groupBy("channel_id", "month_date_id").agg(
        *_resum("spend", "clicks", "impressions", "conversions", "revenue")
    )


def marketing_performance(star: Star) -> DataFrame:
    """Channel and month: sums, return on spend, cost per booking."""
    return (
        _marketing_by_month(star)
        .join(star["DimMarketingChannel"], "channel_id")
        .select(
            "channel_name",
            "channel_type",
            dates.key_year("month_date_id").alias("year"),
            dates.key_month("month_date_id").alias("month"),
            "spend",
            "clicks",
            "impressions",
            "conversions",
            "revenue",
            rate(F.when(F.col("spend") > 0, F.col("revenue")), F.col("spend"), 2).alias("roas"),
            F.coalesce(rate(F.col("spend"), F.col("conversions"), 2), F.lit(0.0)).alias("cost_per_booking"),
        )
    )


@dataclass(frozen=True)
class View:
    """A reporting view: how it is built from the tables and views it reads."""

    build: Callable[[Star], DataFrame]
    reads: tuple[str, ...]


VIEWS = {
    "vw_weather_flagged_cancellations": View(weather_flagged_cancellations, ("FactBookings", "FactWeather", "DimRoute", "DimRegion")),
    "vw_monthly_revenue": View(monthly_revenue, ("FactBookings",)),
    "vw_route_performance": View(route_performance, ("FactBookings", "FactReviews", "DimRoute", "DimRegion")),
    "vw_guide_performance": View(guide_performance, ("FactBookings", "FactReviews", "DimGuide")),
    "vw_customer_summary": View(customer_summary, ("FactBookings", "DimCustomer")),
    "vw_marketing_performance": View(marketing_performance, ("FactMarketing", "DimMarketingChannel")),
    "vw_bookings_enriched": View(
        bookings_enriched,
        ("FactBookings", "DimDate", "DimCustomer", "DimRoute", "DimRegion", "DimGuide", "DimMarketingChannel"),
    ),
}


def views(star: Star, registry: Mapping[str, View] | None = None) -> dict[str, DataFrame]:
    """Every view, each built after those it reads; views see the tables and each other by name."""
    registry = VIEWS if registry is None else registry
    known: dict[str, DataFrame] = dict(star)
    needs = {name: [r for r in view.reads if r in registry] for name, view in registry.items()}
    for name in TopologicalSorter(needs).static_order():
        missing = [r for r in registry[name].reads if r not in known]
        if missing:
            raise KeyError(f"{name} reads {missing}, which neither the tables nor the views hold")
        known[name] = registry[name].build(known)
    return {name: known[name] for name in registry}


def register_views(star: Star, registry: Mapping[str, View] | None = None) -> list[str]:
    """(Re)create the star tables and reporting views as temporary views for SQL users.

    All are built before the first is replaced, so a view that cannot be built leaves the old ones whole.
    """
    found = views(star, registry)
    for name, df in {**star, **found}.items():
        df.createOrReplaceTempView(name)
    return sorted(found)


# ------------------------------------------------------------------ analytical queries


def revenue_by_region(star: Star, min_bookings: int = 100) -> DataFrame:
    """Executive KPIs of the regions with enough volume."""
    per_region = star["FactBookings"].groupBy("region_id").agg(*_totals()).where(F.col("bookings") >= min_bookings)
    return (
        lookup(per_region, "region_id", star["DimRegion"], "region_id", {"name": "region"})
        .where("region IS NOT NULL")
        .select(
            "region",
            F.col("bookings").alias("total_bookings"),
            "revenue",
            rate(F.col("revenue"), F.col("confirmed"), 2).alias("avg_booking_value"),
            "cancellations",
            rate(F.col("cancellations"), F.col("bookings")).alias("cancellation_rate"),
        )
        .orderBy(F.desc("revenue"))
    )


def route_revenue(star: Star) -> DataFrame:
    """Confirmed revenue and bookings by region name, route name and difficulty."""
    routes = star["DimRoute"].select("route_id", F.col("name").alias("route"), "difficulty")
    regions = star["DimRegion"].select("region_id", F.col("name").alias("region"))
    per_key = (
        star["FactBookings"]
        .where(_is("confirmed"))
        .groupBy("region_id", "route_id")
        .agg(F.sum("total_price").alias("revenue"), count_rows().alias("bookings"))
    )
    return (
        per_key.join(routes, "route_id")
        .join(regions, "region_id")
        .groupBy("region", "route", "difficulty")
        .agg(*_resum("revenue", "bookings"))
    )


def top_routes_by_region(star: Star, k: int = 3) -> DataFrame:
    ranked = ranking.top_ranked(route_revenue(star), ["region"], [F.desc("revenue")], k, "revenue_rank")
    return ranked.orderBy("region", "revenue_rank")


def guide_leaderboard(star: Star) -> DataFrame:
    """Active guides numbered by revenue within their primary region; ties by guide id."""
    guides = star["DimGuide"].where("active").select("guide_id", "full_name", "primary_region_id")
    regions = star["DimRegion"].select(
        F.col("region_id").alias("primary_region_id"), F.col("name").alias("primary_region")
    )
    totals = star["FactBookings"].groupBy("guide_id").agg(*_totals())
    ratings = star["FactReviews"].groupBy("guide_id").agg(*_rating("overall_rating"))
    stats = (
        guides.join(regions, "primary_region_id")
        .join(totals, "guide_id", "left")
        .join(ratings, "guide_id", "left")
        .select(
            "guide_id",
            "primary_region",
            "full_name",
            F.coalesce("bookings", F.lit(0)).alias("bookings"),
            F.coalesce("revenue", F.lit(0).cast(MONEY)).alias("revenue"),
            _avg_rating("overall_rating", "avg_rating"),
            rate(F.col("cancellations"), F.col("bookings")).alias("cancellation_rate"),
        )
    )
    order = [F.desc("revenue"), F.asc("guide_id")]
    return (
        ranking.numbered(stats, "region_revenue_rank", order, by=["primary_region"])
        .drop("guide_id")
        .orderBy("primary_region", "region_revenue_rank")
    )


def month_over_month_growth(star: Star) -> DataFrame:
    """Monthly revenue, prior month and change in percent."""
    monthly = monthly_totals(star).select("year", "month", "month_name", "revenue")
    with_prior = series.prior_period(monthly, ["year", "month"], "revenue", "prior_month_revenue")
    pct = series.growth_pct(F.col("revenue"), F.col("prior_month_revenue"))
    return with_prior.withColumn("mom_growth_pct", pct).orderBy("year", "month")


def rebooking_gaps(star: Star) -> DataFrame:
    """(customer_id, booking_date, next_booking_date, days_to_next_booking, pairs): all consecutive trips.

    Bookings are first counted per customer and day. n bookings on one day are
    n-1 pairs with gap 0; the last of them pairs with the next active day.
    Equal pairs are counted, not repeated, so a hot customer stays small.
    """
    trips = star["FactBookings"].where(_completed()).select(
        "customer_id", dates.key_date("tour_date_id").alias("booking_date")
    )
    days = series.event_days(trips, "customer_id", "booking_date")
    following = series.next_day(days, "customer_id", "booking_date", "_next")
    same_day = F.struct(F.col("booking_date").alias("next_booking_date"), (F.col("n") - 1).alias("pairs"))
    next_day = F.struct(F.col("_next").alias("next_booking_date"), F.lit(1).cast("bigint").alias("pairs"))
    return (
        following.select("customer_id", "booking_date", F.inline(F.array(same_day, next_day)))
        .where("pairs > 0 AND next_booking_date IS NOT NULL")
        .withColumn("days_to_next_booking", F.datediff("next_booking_date", "booking_date"))
        .select("customer_id", "booking_date", "next_booking_date", "days_to_next_booking", "pairs")
    )


def repeat_customer_intervals(star: Star, limit: int = 50) -> DataFrame:
    """The shortest rebooking gaps, one row per pair; names are looked up for the kept rows only.

    Repeats are written out after the first cut: ``limit`` distinct pairs
    always contain the ``limit`` shortest ones.
    """
    order = ["days_to_next_booking", "customer_id", "booking_date"]
    shortest = rebooking_gaps(star).orderBy(*order).limit(limit)
    copies = F.sequence(F.lit(1), F.least("pairs", F.lit(limit)).cast("int"))
    repeated = shortest.withColumn("_copy", F.explode(copies)).orderBy(*order).limit(limit)
    named = lookup(repeated, "customer_id", star["DimCustomer"], "customer_id", {"contact_name": "contact_name"})
    return named.select(
        "customer_id", "contact_name", "booking_date", "next_booking_date", "days_to_next_booking"
    ).orderBy(*order)


def flagged_cancellation_days(star: Star) -> DataFrame:
    """Cancelled bookings per region and day with that day's weather flag (NULL without weather).

    Counting before the weather join turns a booking-grain join into a
    region-day one.
    """
    per_day = (
        star["FactBookings"].where(_is("cancelled")).groupBy("region_id", "tour_date_id").agg(count_rows().alias("n"))
    )
    weather = star["FactWeather"].select(
        "region_id", F.col("date_id").alias("tour_date_id"), bad_weather().alias("flagged")
    )
    return per_day.join(weather, ["region_id", "tour_date_id"], "left")


def cancellation_drivers(star: Star) -> DataFrame:
    """Region and month: cancellations, those on bad-weather days, trading season."""
    month = dates.key_month("tour_date_id")
    flagged = F.when(F.col("flagged"), F.col("n")).otherwise(0)
    per_month = (
        lookup(flagged_cancellation_days(star), "region_id", star["DimRegion"], "region_id", {"name": "region"})
        .where("region IS NOT NULL")
        .groupBy(
            "region",
            dates.month_name(dates.key_date("tour_date_id")).alias("month_name"),
            dates.trading_season(month).alias("season_bucket"),
        )
        .agg(F.sum("n").alias("total_cancellations"), F.sum(flagged).alias("weather_flagged_cancellations"))
    )
    share = rate(F.col("weather_flagged_cancellations"), F.col("total_cancellations"))
    return per_month.withColumn("weather_flagged_share", share).orderBy(F.desc("total_cancellations"))


def channel_mix(star: Star) -> DataFrame:
    """Every channel, also one without marketing rows (then year and month are empty)."""
    channels = star["DimMarketingChannel"]
    by_month = _marketing_by_month(star)
    return (
        by_month.join(channels, "channel_id", "right")
        .select(
            "channel_name",
            "channel_type",
            dates.key_year("month_date_id").alias("year"),
            dates.key_month("month_date_id").alias("month"),
            F.coalesce("conversions", F.lit(0)).alias("conversions"),
            F.coalesce("spend", F.lit(0).cast(MONEY)).alias("spend"),
            F.coalesce("revenue", F.lit(0).cast(MONEY)).alias("revenue"),
        )
        .orderBy("year", "month", "channel_name")
    )


# Retention windows in days after the first trip, and the age a
# cohort needs before its 12-month figure is meaningful.
SIX_MONTHS, TWELVE_MONTHS = 182, 365
MIN_COHORT_AGE_MONTHS = 13


def months_back(day: Column, months: int) -> Column:
    """Month arithmetic that carries surplus days into the next month (31 March - 13 months = 2 March)."""
    first = F.add_months(F.trunc(day, "MM"), -months)
    return F.date_add(first, F.day(day) - 1)


def first_and_second_trip(star: Star) -> DataFrame:
    """(customer_id, first_day, second_day): first two distinct trip days of each customer.

    A customer rebooked within k days exactly when the second distinct day is
    at most k days after the first, so no customer's history is joined to itself.
    """
    trips = star["FactBookings"].where(_completed()).select("customer_id", "tour_date_id").distinct()
    w = Window.partitionBy("customer_id").orderBy("tour_date_id")
    return (
        trips.withColumn("second", F.lead("tour_date_id").over(w))
        .withColumn("rank", F.row_number().over(w))
        .where("rank = 1")
        .select(
            "customer_id",
            dates.key_date("tour_date_id").alias("first_day"),
            dates.key_date("second").alias("second_day"),
        )
    )


def cohort_retention(star: Star) -> DataFrame:
    """Cohorts by month of the first trip: size and share that came back within 6 and 12 months."""
    gap = F.datediff("second_day", "first_day")
    cohorts = (
        first_and_second_trip(star)
        .groupBy(dates.year_month("first_day").alias("cohort_month"))
        .agg(
            count_rows().alias("cohort_size"),
            F.count_if(gap <= SIX_MONTHS).alias("rebooked_6m"),
            F.count_if(gap <= TWELVE_MONTHS).alias("rebooked_12m"),
        )
    )
    last_day = star["DimDate"].agg(F.max("full_date").alias("d"))
    cutoff = last_day.select(dates.year_month(months_back(F.col("d"), MIN_COHORT_AGE_MONTHS))).scalar()
    return (
        cohorts.where(F.col("cohort_month") <= cutoff)
        .withColumn("retention_6m", rate(F.col("rebooked_6m"), F.col("cohort_size")))
        .withColumn("retention_12m", rate(F.col("rebooked_12m"), F.col("cohort_size")))
        .orderBy("cohort_month")
    )


def confirmed_revenue_by_region(star: Star) -> DataFrame:
    per_region = (
        star["FactBookings"]
        .where(_is("confirmed"))
        .groupBy("region_id")
        .agg(F.sum("total_price").alias("revenue"), count_rows().alias("bookings"))
    )
    named = per_region.join(star["DimRegion"].select("region_id", F.col("name").alias("region")), "region_id")
    return named.select("region", "revenue", "bookings").orderBy(F.desc("revenue"))


# ------------------------------------------------------------------ parameterised reports


def guide_performance_report(star: Star, guide_id: int, year: int) -> DataFrame:
    """One guide, one year; the guide's row stays when there are no bookings.

    The rating covers bookings of any status, the other figures confirmed ones.
    """
    booked = in_years(star["FactBookings"], "tour_date_id", [year]).where(F.col("guide_id") == guide_id)
    ratings = star["FactReviews"].select("booking_id", "guide_rating")
    figures = (
        booked.join(ratings, "booking_id", "left")
        .groupBy("guide_id")
        .agg(
            F.count_if(_is("confirmed")).alias("bookings"),
            sum_if(_is("confirmed"), F.col("total_price")).alias("revenue"),
            avg_exact(F.col("guide_rating")).alias("avg_guide_rating"),
        )
    )
    guide = star["DimGuide"].where(F.col("guide_id") == guide_id).select("guide_id", "full_name")
    return guide.join(figures, "guide_id", "left").select(
        "full_name",
        F.lit(year).alias("report_year"),
        F.coalesce("bookings", F.lit(0)).alias("bookings"),
        F.coalesce("revenue", F.lit(0).cast(MONEY)).alias("revenue"),
        "avg_guide_rating",
    )


def route_performance_report(star: Star, route_id: int) -> DataFrame:
    """One route over all time."""
    booked = star["FactBookings"].where(F.col("route_id") == route_id)
    ratings = star["FactReviews"].select("booking_id", "overall_rating")
    figures = (
        booked.join(ratings, "booking_id", "left")
        .groupBy("route_id")
        .agg(
            F.count("booking_id").alias("bookings"),
            sum_if(_is("confirmed"), F.col("total_price")).alias("revenue"),
            avg_exact(F.col("overall_rating")).alias("avg_rating"),
        )
    )
    route = star["DimRoute"].where(F.col("route_id") == route_id).select("route_id", "name", "difficulty")
    return route.join(figures, "route_id", "left").select(
        "name",
        "difficulty",
        F.coalesce("bookings", F.lit(0)).alias("bookings"),
        F.coalesce("revenue", F.lit(0).cast(MONEY)).alias("revenue"),
        "avg_rating",
    )


def customer_ltv(star: Star) -> DataFrame:
    """Lifetime value and bookings of each customer."""
    return star["FactBookings"].groupBy("customer_id").agg(
        sum_if(_is("confirmed"), F.col("total_price")).alias("lifetime_value"), count_rows().alias("total_bookings")
    )


def refresh_customer_ltv_snapshot(spark: SparkSession, star: Star, path: str) -> DataFrame:
    """Publish a new version of the snapshot and report how many customers it holds.

    A refresh that fails leaves the version before in force.
    """
    snapshots.publish(customer_ltv(star).withColumn("last_refreshed", F.current_timestamp()), path)
    return snapshots.current(spark, path).agg(count_rows().alias("customers_refreshed"))


def sql_report(spark: SparkSession, query: str, **params: object) -> DataFrame:
    """Any SQL over the registered views with bound parameters (``:name``)."""
    return spark.sql(query, args=params)
