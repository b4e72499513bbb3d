"""Star-schema build: six dimensions, seven facts, load, views and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import calendar, dates, text
from starmart.functions.numbers import count_rows
from starmart.operators.lookup import lookup, spread_blank
from starmart.operators.ranking import latest_known, numbered
from starmart.plans import reports
from starmart.schemas import CHANNELS, DATE_YEAR, PAID_CHANNELS, PARTITION_DATE, STAR
from starmart.sources.files import conform, read_clean, read_star, star_path, write_csv, write_table

DIMENSIONS = ("DimDate", "DimRegion", "DimGuide", "DimRoute", "DimCustomer", "DimMarketingChannel")
FACTS = (
    "FactBookings",
    "FactPayments",
    "FactReviews",
    "FactEquipmentHire",
    "FactMarketing",
    "FactWebsiteAnalytics",
    "FactWeather",
)
LOAD_ORDER = DIMENSIONS + FACTS

# The summaries exported next to the star tables.
SUMMARY_EXPORTS = {
    "vw_customer_summary": "Summary_CustomerLTV",
    "vw_guide_performance": "Summary_GuidePerformance",
    "vw_route_performance": "Summary_RoutePerformance",
    "vw_weather_flagged_cancellations": "Summary_WeatherFlaggedCancellations",
}


# ------------------------------------------------------------------ dimensions


def warehouse_span(clean: dict[str, DataFrame]) -> DataFrame:
    """First and last day over the seven date columns that feed the calendar."""
    return calendar.date_span(
        (clean["ScheduledTour"], "date"),
        (clean["Booking"], "created_at"),
        (clean["Weather"], "date"),
        (clean["Marketing"], "month"),
        (clean["WebsiteAnalytics"], "week_starting"),
        (clean["Payment"], "paid_at", "refunded_at"),
    )


def dim_region(regions: DataFrame) -> DataFrame:
    return regions.select("region_id", "name", "slug")


def dim_guide(guides: DataFrame, regions: DataFrame) -> DataFrame:
    found = lookup(guides, "primary_region", regions, "name", {"region_id": "primary_region_id"})
    named = found.withColumn("full_name", text.full_name("first_name", "last_name"))
    return named.select(*STAR["DimGuide"].fields)


def dim_route(routes: DataFrame, regions: DataFrame) -> DataFrame:
    return lookup(routes, "region", regions, "name", {"region_id": "region_id"}).select(*STAR["DimRoute"].fields)


def customers_by_email(bookings: DataFrame) -> DataFrame:
    """One row per e-mail key with the latest known name and phone; ties go to the larger booking id."""
    recent = F.struct("created_at", "booking_id")
    return (
        bookings.withColumn("contact_email", text.email_key("contact_email"))
        .where("contact_email <> ''")
        .groupBy("contact_email")
        .agg(
            latest_known("contact_name", recent).alias("contact_name"),
            latest_known("contact_phone", recent).alias("contact_phone"),
        )
    )


def dim_customer(bookings: DataFrame) -> DataFrame:
    """Customers numbered in e-mail order."""
    ids = numbered(customers_by_email(bookings), "customer_id", [F.col("contact_email").asc()])
    return ids.select(*STAR["DimCustomer"].fields)


def dim_marketing_channel(spark: SparkSession) -> DataFrame:
    rows = [(i, c, "paid" if c in PAID_CHANNELS else "unpaid") for i, c in enumerate(CHANNELS, start=1)]
    return spark.createDataFrame(rows, STAR["DimMarketingChannel"].ddl)


# ------------------------------------------------------------------ facts


def fact_bookings(clean: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Bookings with tour, route, region, customer and channel keys.

    The customer is looked up by e-mail once, here; afterwards only its long id
    is used. Bookings without an address get a join key of their own so they do
    not pile up in one partition.
    """
    tours = clean["ScheduledTour"].select("tour_id", "route_id", "guide_id", "date", "season")
    df = clean["Booking"].join(tours, "tour_id", "left")
    df = lookup(df, "route_id", dims["DimRoute"], "route_id", {"region_id": "region_id"})
    df = df.withColumn("_email", spread_blank(text.email_key("contact_email"), F.col("booking_id")))
    df = lookup(df, "_email", dims["DimCustomer"], "contact_email", {"customer_id": "customer_id"})
    df = df.join(clean["BookingAttribution"], "booking_id", "left")
    df = lookup(df, "channel", dims["DimMarketingChannel"], "channel_name", {"channel_id": "channel_id"})
    out = (
        df.withColumn("tour_date_id", dates.date_key("date"))
        .withColumn("created_date_id", dates.date_key("created_at"))
        .withColumn("lead_time_days", F.datediff("date", F.to_date("created_at")))
    )
    return conform(out, STAR["FactBookings"])


# The foreign keys a booking must have to be loaded.
MANDATORY_KEYS = ("customer_id", "route_id", "region_id", "tour_date_id", "created_date_id")


def with_outcome(bookings: DataFrame) -> DataFrame:
    """Bookings with ``outcome``: loaded, or rejected for want of a mandatory key. They are kept apart, not lost."""
    complete = F.lit(True)
    for key in MANDATORY_KEYS:
        complete = complete & F.col(key).isNotNull()
    return bookings.withColumn("outcome", F.when(complete, "loaded").otherwise("rejected"))


def fact_payments(payments: DataFrame) -> DataFrame:
    out = payments.withColumn("paid_date_id", dates.date_key("paid_at")).withColumn(
        "refunded_date_id", dates.date_key("refunded_at")
    )
    return conform(out, STAR["FactPayments"])


def fact_reviews(reviews: DataFrame, bookings: DataFrame) -> DataFrame:
    keys = bookings.select("booking_id", "customer_id", "route_id", "guide_id")
    return conform(reviews.join(keys, "booking_id", "left"), STAR["FactReviews"])


def fact_equipment_hire(hires: DataFrame, bookings: DataFrame) -> DataFrame:
    keys = bookings.select("booking_id", "customer_id")
    return conform(hires.join(keys, "booking_id", "left"), STAR["FactEquipmentHire"])


def _with_id(df: DataFrame, name: str, contract: str, order: list[str]) -> DataFrame:
    """Surrogate key 1..n in the order of the natural key, all columns breaking ties."""
    keys = order + [c for c in df.columns if c not in order]
    return conform(numbered(df, name, [F.col(c).asc_nulls_first() for c in keys]), STAR[contract])


def fact_marketing(marketing: DataFrame, channels: DataFrame) -> DataFrame:
    df = lookup(marketing, "channel", channels, "channel_name", {"channel_id": "channel_id"})
    df = df.withColumn("month_date_id", dates.date_key("month"))
    return _with_id(df, "marketing_id", "FactMarketing", ["month_date_id", "channel_id", "campaign"])


def fact_website_analytics(website: DataFrame, channels: DataFrame) -> DataFrame:
    df = lookup(website, "traffic_source", channels, "channel_name", {"channel_id": "channel_id"})
    df = df.withColumn("week_date_id", dates.date_key("week_starting"))
    return _with_id(df, "website_analytics_id", "FactWebsiteAnalytics", ["week_date_id", "channel_id", "device"])


def fact_weather(weather: DataFrame, regions: DataFrame) -> DataFrame:
    df = lookup(weather, "region", regions, "name", {"region_id": "region_id"})
    df = df.withColumn("date_id", dates.date_key("date"))
    return _with_id(df, "weather_id", "FactWeather", ["date_id", "region_id"])


# ------------------------------------------------------------------ job


def load(df: DataFrame, folder: str, name: str) -> None:
    """Write one star table; dated facts are laid out by year."""
    path = star_path(folder, name)
    if name in PARTITION_DATE:
        write_table(df.withColumn(DATE_YEAR, dates.key_year(PARTITION_DATE[name])), path, DATE_YEAR)
    else:
        write_table(df, path)


def load_bookings(bookings: DataFrame, folder: str) -> None:
    """Write loaded and rejected bookings in one go, so the joins behind them run once."""
    year = dates.key_year(PARTITION_DATE["FactBookings"])
    write_table(with_outcome(bookings).withColumn(DATE_YEAR, year), f"{folder}/FactBookings", "outcome", DATE_YEAR)


def rejected_bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings that were not loaded; none if all were."""
    stored = spark.read.parquet(f"{folder}/FactBookings").where(F.col("outcome") == "rejected")
    return stored.select(*STAR["FactBookings"].fields)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, measure, total) of stored tables: a row for each numeric column, one scan for each table.

    Two loads of the same input have the same manifest; so have a table and its export.
    """
    parts = []
    for name, df in tables.items():
        numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != DATE_YEAR]
        exact = {f.name: isinstance(f.dataType, (T.DecimalType, T.IntegralType)) for f in df.schema.fields}
        one = df.agg(count_rows().alias("rows"), *[(F.sum(F.col(c).cast("decimal(38,2)") if exact[c] else F.col(c))).cast("double").alias(c) for c in numeric])
        pairs = [F.struct(F.lit(c).alias("measure"), F.col(c).alias("total")) for c in numeric]
        parts.append(one.select(F.lit(name).alias("table"), "rows", F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def build_warehouse(spark: SparkSession, clean_dir: str, out_dir: str) -> dict[str, DataFrame]:
    """Build and load all tables, dimensions before facts.

    Each table is read back after it is written: later tables use the stored
    rows, so lineage stays short and a lost executor never repeats the cleaning.
    """
    clean = {name: read_clean(spark, clean_dir, name) for name in _CLEAN_TABLES}
    stored: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> None:
        load(df, out_dir, name)
        stored[name] = read_star(spark, out_dir, name)

    store("DimDate", calendar.date_dimension(warehouse_span(clean)))
    store("DimRegion", dim_region(clean["Region"]))
    store("DimGuide", dim_guide(clean["Guide"], stored["DimRegion"]))
    store("DimRoute", dim_route(clean["Route"], stored["DimRegion"]))
    store("DimCustomer", dim_customer(clean["Booking"]))
    store("DimMarketingChannel", dim_marketing_channel(spark))
    load_bookings(fact_bookings(clean, stored), out_dir)
    stored["FactBookings"] = read_star(spark, out_dir, "FactBookings")
    store("FactPayments", fact_payments(clean["Payment"]))
    store("FactReviews", fact_reviews(clean["Review"], stored["FactBookings"]))
    store("FactEquipmentHire", fact_equipment_hire(clean["EquipmentHire"], stored["FactBookings"]))
    store("FactMarketing", fact_marketing(clean["Marketing"], stored["DimMarketingChannel"]))
    store("FactWebsiteAnalytics", fact_website_analytics(clean["WebsiteAnalytics"], stored["DimMarketingChannel"]))
    store("FactWeather", fact_weather(clean["Weather"], stored["DimRegion"]))
    write_table(manifest(stored), f"{out_dir}/Manifest")
    return stored


_CLEAN_TABLES = (
    "Region",
    "Guide",
    "Route",
    "ScheduledTour",
    "Booking",
    "Payment",
    "Review",
    "Weather",
    "BookingAttribution",
    "Marketing",
    "WebsiteAnalytics",
    "EquipmentHire",
)


def open_warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored star tables."""
    return {name: read_star(spark, folder, name) for name in LOAD_ORDER}


def export_csv(star: dict[str, DataFrame], folder: str) -> list[str]:
    """13 star tables and 4 summaries as headered CSV folders; returns their names."""
    views = reports.views(star)
    for name in LOAD_ORDER:
        write_csv(star[name].select(*STAR[name].fields), f"{folder}/{name}")
    for view, name in SUMMARY_EXPORTS.items():
        write_csv(views[view], f"{folder}/{name}")
    return [*LOAD_ORDER, *SUMMARY_EXPORTS.values()]


