"""Analyses behind the insight report, and roll-ups that feed the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.numbers import count_rows, rate, ratio
from starmart.operators import series
from starmart.operators.lookup import lookup
from starmart.plans.reports import Star, _completed, _is, _rating, _totals, bad_weather, flagged_cancellation_days


def yearly_revenue(star: Star) -> DataFrame:
    """Confirmed revenue per year and change on the year before in percent."""
    years = star["FactBookings"].groupBy(dates.key_year("tour_date_id").alias("year"))
    per_year = years.agg(*_totals()).select("year", "revenue")
    with_past = series.same_period_last_year(per_year, "year", "revenue", "prior_year_revenue")
    return with_past.withColumn("yoy_pct", series.growth_pct(F.col("revenue"), F.col("prior_year_revenue")))


def daily_revenue(star: Star) -> DataFrame:
    """Confirmed revenue per tour day (days with sales)."""
    return (
        star["FactBookings"]
        .where(_is("confirmed"))
        .groupBy("tour_date_id")
        .agg(F.sum("total_price").alias("revenue"))
    )


def revenue_by_day_type(star: Star) -> DataFrame:
    """Mean daily revenue of weekdays, weekends and bank holidays, and the multiple of a weekday."""
    calendar = star["DimDate"].select(
        F.col("date_id").alias("tour_date_id"),
        F.when(F.col("is_bank_holiday"), "bank_holiday")
        .when(F.col("is_weekend"), "weekend")
        .otherwise("weekday")
        .alias("day_type"),
    )
    by_type = (
        daily_revenue(star)
        .join(calendar, "tour_date_id")
        .groupBy("day_type")
        .agg(count_rows().alias("days"), F.sum("revenue").alias("total"))
    )
    mean = by_type.withColumn("avg_revenue", ratio(F.col("total"), F.col("days")))
    weekday = series.over_all(F.max(F.when(F.col("day_type") == "weekday", F.col("avg_revenue"))))
    return mean.select(
        "day_type",
        "days",
        F.round("avg_revenue", 2).alias("avg_revenue"),
        F.round(ratio(F.col("avg_revenue"), weekday), 2).alias("multiple_of_weekday"),
    )


def region_concentration(star: Star, top: int = 2) -> DataFrame:
    """Region revenue, bookings, share of revenue, and the share held by the top regions."""
    per_region = star["FactBookings"].groupBy("region_id").agg(*_totals())
    named = lookup(per_region, "region_id", star["DimRegion"], "region_id", {"name": "region"}).select(
        "region", "revenue", "bookings"
    )
    place = F.row_number().over(Window.orderBy(F.desc("revenue"), "region"))  # one row per region
    leaders = series.over_all(F.sum(F.when(F.col("_place") <= top, F.col("revenue"))))
    total = series.over_all(F.sum("revenue"))
    return (
        named.withColumn("_place", place)
        .withColumn("revenue_share", F.round(ratio(F.col("revenue"), total), 4))
        .withColumn("top_regions_share", F.round(ratio(leaders, total), 4))
        .drop("_place")
    )


def difficulty_profile(star: Star) -> DataFrame:
    """Average rating and cancellation rate per difficulty."""
    totals = star["FactBookings"].groupBy("route_id").agg(*_totals())
    ratings = star["FactReviews"].groupBy("route_id").agg(*_rating("overall_rating"))
    return (
        totals.join(ratings, "route_id", "left")
        .join(star["DimRoute"].select("route_id", "difficulty"), "route_id")
        .groupBy("difficulty")
        .agg(
            rate(F.sum("overall_rating_sum"), F.sum("overall_rating_n"), 2).alias("avg_rating"),
            rate(F.sum("cancellations"), F.sum("bookings")).alias("cancellation_rate"),
        )
    )


def guide_discounts(star: Star) -> DataFrame:
    """Per guide: discount tendency, bookings, discounted share, confirmed revenue."""
    facts = star["FactBookings"].groupBy("guide_id").agg(
        *_totals(), F.count_if("discount_applied").alias("discounted")
    )
    return star["DimGuide"].join(facts, "guide_id").select(
        "guide_id",
        "full_name",
        "discount_tendency_pct",
        "bookings",
        "revenue",
        ratio(F.col("discounted"), F.col("bookings")).alias("discounted_share"),
    )


def top_discounting_guides(star: Star, n: int = 5) -> DataFrame:
    return guide_discounts(star).orderBy(F.desc("discount_tendency_pct"), "guide_id").limit(n)


def discount_correlation(star: Star, min_bookings: int = 50) -> DataFrame:
    """Does a guide's discount tendency show in the bookings? Covariance and correlation over guides."""
    busy = guide_discounts(star).where(F.col("bookings") > min_bookings)
    return busy.agg(
        count_rows().alias("guides"),
        F.round(F.covar_samp("discount_tendency_pct", "discounted_share"), 9).alias("covariance"),
        F.round(F.corr("discount_tendency_pct", "discounted_share"), 9).alias("correlation"),
    )


def repeat_customers(star: Star) -> DataFrame:
    """Unique and repeat customers under both definitions: any status, and trips only."""
    per_customer = star["FactBookings"].groupBy("customer_id").agg(
        count_rows().alias("bookings"), F.count_if(_completed()).alias("trips")
    )
    any_status, trips = F.count_if(F.col("bookings") > 1), F.count_if(F.col("trips") > 1)
    return per_customer.where("customer_id IS NOT NULL").agg(
        count_rows().alias("unique_customers"),
        any_status.alias("repeat_any_status"),
        trips.alias("repeat_trips"),
        rate(any_status, count_rows()).alias("repeat_rate_any_status"),
        rate(trips, count_rows()).alias("repeat_rate_trips"),
    )


def channel_returns(star: Star) -> DataFrame:
    """Spend, revenue and return on spend per channel over all months."""
    sums = star["FactMarketing"].groupBy("channel_id").agg(
        F.sum("spend").alias("spend"), F.sum("revenue").alias("revenue")
    )
    return sums.join(star["DimMarketingChannel"], "channel_id").select(
        "channel_name", "spend", "revenue", F.round(ratio(F.col("revenue"), F.col("spend")), 1).alias("roas")
    )


def weather_share_of_cancellations(star: Star) -> DataFrame:
    flagged = F.coalesce(F.sum(F.when(F.col("flagged"), F.col("n"))), F.lit(0))
    return flagged_cancellation_days(star).agg(
        F.sum("n").alias("cancellations"),
        flagged.alias("weather_flagged"),
        rate(flagged, F.sum("n")).alias("weather_flagged_share"),
    )


def payment_health(star: Star) -> DataFrame:
    """Count and amount per payment status, with success and refund rates over all."""
    by_status = star["FactPayments"].groupBy("status").agg(
        count_rows().alias("payments"), F.sum("amount").alias("amount")
    )

    def number(status: str) -> Column:
        return F.coalesce(series.over_all(F.sum(F.when(F.col("status") == status, F.col("payments")))), F.lit(0))

    return by_status.withColumn("success_rate", rate(number("paid"), number("paid") + number("failed"))).withColumn(
        "refund_rate", rate(number("refunded"), number("paid"))
    )


def discount_cost(star: Star) -> DataFrame:
    """Share of trips with a discount, amount given away, share of gross revenue."""
    given = F.sum(F.col("list_price") - F.col("total_price"))
    return star["FactBookings"].where(_completed()).agg(
        rate(F.count_if("discount_applied"), count_rows()).alias("discounted_share"),
        given.alias("discount_given"),
        rate(given, F.sum("list_price")).alias("share_of_gross"),
    )


# ------------------------------------------------------------------ roll-ups


def attributed_conversions(bookings: DataFrame, attribution: DataFrame) -> DataFrame:
    """Conversions and revenue per channel and month of creation, trips only.

    ``bookings`` needs booking_id, status, created_date, total_price; ``attribution`` booking_id, channel.
    """
    trips = bookings.where(_completed()).select("booking_id", "created_date", "total_price")
    return (
        trips.join(attribution, "booking_id", "left")
        .groupBy("channel", F.trunc("created_date", "MM").alias("month"))
        .agg(count_rows().alias("conversions"), F.sum("total_price").alias("revenue"))
    )


def tour_statuses(tours: DataFrame, bookings: DataFrame) -> DataFrame:
    """(tour_id, booked, status): cancelled by operations, full, or open.

    ``tours`` needs tour_id, max_group_size, ops_cancelled; the seats of every
    booking count, whatever its status. A tour nobody booked stays open.
    """
    seats = bookings.groupBy("tour_id").agg(F.sum("party_size").alias("booked"))
    booked = F.coalesce("booked", F.lit(0))
    status = (
        F.when(F.col("ops_cancelled"), "cancelled").when(booked >= F.col("max_group_size"), "full").otherwise("open")
    )
    return tours.join(seats, "tour_id", "left").select("tour_id", booked.alias("booked"), status.alias("status"))


def storm_days(star: Star) -> DataFrame:
    """Storm-warning and bad-weather days per region."""
    per_region = star["FactWeather"].groupBy("region_id").agg(
        F.count_if("storm_warning").alias("storm_days"), F.count_if(bad_weather()).alias("bad_weather_days")
    )
    return lookup(per_region, "region_id", star["DimRegion"], "region_id", {"name": "region"}).drop("region_id")


