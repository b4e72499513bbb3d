"""TPC-H-style and event tables read in star-schema roles.

Orders and line items stand in for bookings, suppliers for guides, parts for
routes, events for payments and web traffic, labelled documents for reviews,
and the daily line-item extremes of a region for its weather. Everything is
derived lazily from whole tables; joins that a report does not need can be
left out by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import calendar, dates
from starmart.functions.numbers import MONEY, money
from starmart.operators.lookup import lookup
from starmart.plans.reports import Star
from starmart.plans.warehouse import dim_marketing_channel


# Explicit schemas: opening a table then needs no job to read file footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


class LazyStar(Mapping):
    """Star tables built when a report first asks for them."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _decode(column: str, values: dict[str, str | int], default: str | int) -> Column:
    out = F.lit(default)
    for key, value in values.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def _season(day: Column) -> Column:
    return F.when(F.month(day).isin(11, 12, 1, 2, 3), "winter").otherwise("summer")


def with_region(df: DataFrame, spark: SparkSession, folder: str, nation: str, into: str = "region_id") -> DataFrame:
    """Adds the region key of a nation key and drops the nation key."""
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_regionkey").cast("bigint").alias("_region"))
    return lookup(df, nation, nations, "n_nationkey", {"_region": into}).drop(nation)


def dim_region(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("region_id"),
        F.col("r_name").alias("name"),
        F.lower("r_name").alias("slug"),
    )


def span(spark: SparkSession, folder: str) -> DataFrame:
    """(lo, hi) over all dates of the star: bookings, their creation, and what events turn into."""
    orders = table(spark, folder, "orders").select(
        "o_orderdate", F.date_sub(F.to_date("o_orderdate"), F.pmod("o_orderkey", F.lit(120)).cast("int")).alias("created")
    )
    events = table(spark, folder, "events").select(
        F.date_trunc("week", "ts").alias("week"), F.date_add(F.to_date("ts"), 13).alias("refunded")
    )
    lines = table(spark, folder, "lineitem")
    return calendar.date_span((orders, "o_orderdate", "created"), (lines, "l_shipdate"), (events, "week", "refunded"))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.date_dimension(span(spark, folder))


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("contact_email"),
        F.col("c_name").alias("contact_name"),
        F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("contact_phone"),
    )


def dim_guide(spark: SparkSession, folder: str) -> DataFrame:
    years = F.floor(F.abs(money("s_acctbal")) / 400).cast("int")
    guides = table(spark, folder, "supplier").withColumn("_nation", F.col("s_nationkey"))
    return with_region(guides, spark, folder, "_nation", "primary_region_id").select(
        F.col("s_suppkey").alias("guide_id"),
        F.col("s_name").alias("full_name"),
        years.alias("years_experience"),
        F.when(F.col("s_nationkey") < 12, "employed").otherwise("freelance").alias("employment_type"),
        F.abs(money("s_acctbal")).alias("day_rate_gbp"),
        "primary_region_id",
        (money("s_acctbal") >= 0).alias("active"),
        (years / 100).cast("double").alias("discount_tendency_pct"),
    )


def dim_route(spark: SparkSession, folder: str) -> DataFrame:
    difficulty = _decode(
        "p_type", {"ECONOMY": "moderate", "SMALL": "moderate", "MEDIUM": "hard", "STANDARD": "hard"}, "advanced"
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("route_id"),
        F.col("p_name").alias("name"),
        F.pmod("p_size", F.lit(5)).cast("bigint").alias("region_id"),
        difficulty.alias("difficulty"),
        F.col("p_size").cast("double").alias("distance_km"),
    )


def order_bookings(spark: SparkSession, folder: str, region: bool = True) -> DataFrame:
    """One booking per order."""
    day = F.to_date("o_orderdate")
    lead = F.pmod("o_orderkey", F.lit(120)).cast("int")
    df = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.concat(F.lit("B-"), F.col("o_orderkey").cast("string")).alias("booking_reference"),
        F.col("o_custkey").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("channel_id"),
        dates.date_key(day).alias("tour_date_id"),
        dates.date_key(F.date_sub(day, lead)).alias("created_date_id"),
        lead.alias("lead_time_days"),
        _season(day).alias("season"),
        _decode("o_orderstatus", {"F": "confirmed", "O": "amended"}, "cancelled").alias("status"),
        (F.pmod("o_orderkey", F.lit(3)) + 1).cast("int").alias("party_size"),
        money("o_totalprice").alias("total_price"),
    )
    if not region:
        return df
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    df = lookup(df, "customer_id", customers, "c_custkey", {"c_nationkey": "_nation"})
    return with_region(df, spark, folder, "_nation")


def line_bookings(spark: SparkSession, folder: str, region: bool = True, order: bool = False) -> DataFrame:
    """One booking per line item; ``order`` adds customer, channel and creation date."""
    day = F.to_date("l_shipdate")
    discount = F.col("l_discount").cast("decimal(4,2)")
    df = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("booking_id"),
        F.concat(F.lit("L-"), F.col("l_orderkey").cast("string")).alias("booking_reference"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("route_id"),
        F.col("l_suppkey").alias("guide_id"),
        dates.date_key(day).alias("tour_date_id"),
        _season(day).alias("season"),
        _decode("l_returnflag", {"A": "confirmed", "N": "pending"}, "cancelled").alias("status"),
        (F.pmod(F.col("l_quantity").cast("int"), F.lit(3)) + 1).alias("party_size"),
        money("l_extendedprice").alias("list_price"),
        F.col("l_discount").alias("discount_pct"),
        (F.col("l_discount") > 0).alias("discount_applied"),
        (money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - discount)).cast(MONEY).alias("total_price"),
    )
    if region:
        guides = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        df = lookup(df, "guide_id", guides, "s_suppkey", {"s_nationkey": "_nation"})
        df = with_region(df, spark, folder, "_nation")
    if order:
        orders = table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("booking_id"),
            F.col("o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("channel_id"),
            dates.date_key("o_orderdate").alias("created_date_id"),
        )
        df = df.join(orders, "booking_id").withColumn(
            "lead_time_days", F.datediff(dates.key_date("tour_date_id"), dates.key_date("created_date_id"))
        )
    return df


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review per document; ratings come from its labels and are missing without them."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("_doc"), "quality", "toxic")
    odd = F.pmod("n_chars", F.lit(2))
    return docs.join(labels, F.col("doc_id") == F.col("_doc"), "left").select(
        F.col("doc_id").alias("booking_id"),
        (2 + 2 * F.col("quality") + odd).cast("int").alias("overall_rating"),
        (5 - 3 * F.col("toxic") - odd).cast("int").alias("guide_rating"),
        (1 + 3 * F.col("quality") + odd).cast("int").alias("route_rating"),
        (F.pmod("n_chars", F.lit(5)) + 1).cast("int").alias("safety_rating"),
        (1 + 4 * F.col("quality")).cast("int").alias("value_rating"),
        F.col("n_chars").cast("int").alias("comment_length"),
        (F.col("quality") == 1).alias("would_recommend"),
    )


def line_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The review of an order attached to each of its lines, with route and guide keys."""
    lines = line_bookings(spark, folder, region=False).select("booking_id", "route_id", "guide_id")
    return lines.join(reviews(spark, folder), "booking_id")


def payments(spark: SparkSession, folder: str) -> DataFrame:
    status = _decode(
        "event_type", {"purchase": "paid", "error": "failed", "signup": "pending", "view": "refunded"}, "refund_pending"
    )
    day = F.to_date("ts")
    later = F.date_add(day, F.pmod("event_id", F.lit(14)).cast("int"))
    settled = F.col("event_type").isin("purchase", "view")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("payment_id"),
        F.col("event_id").alias("booking_id"),
        money("value").alias("amount"),
        F.lit("GBP").alias("currency"),
        status.alias("status"),
        F.when(settled, dates.date_key(day)).alias("paid_date_id"),
        F.when(F.col("event_type") == "view", dates.date_key(later)).alias("refunded_date_id"),
    )


def equipment(spark: SparkSession, folder: str) -> DataFrame:
    """A hire per purchase event."""
    return (
        table(spark, folder, "events")
        .where("event_type = 'purchase'")
        .select(F.col("event_id").alias("booking_id"), money("value").alias("hire_revenue"))
    )


def marketing(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per channel and month: cancelled value of the paid channels is the spend."""
    channel = F.substring("o_orderpriority", 1, 1).cast("bigint")
    price = money("o_totalprice")
    won = F.col("o_orderstatus").isin("F", "O")
    paid = F.col("channel_id") >= 4
    return (
        table(spark, folder, "orders")
        .withColumn("channel_id", channel)
        .groupBy("channel_id", dates.date_key(F.trunc(F.to_date("o_orderdate"), "MM")).alias("month_date_id"))
        .agg(
            F.sum(F.when(paid & ~won, price).otherwise(F.lit(0).cast(MONEY))).alias("spend"),
            (F.count(F.lit(1)) * 25).alias("clicks"),
            (F.count(F.lit(1)) * 400).alias("impressions"),
            F.count_if(won).alias("conversions"),
            F.sum(F.when(won, price).otherwise(F.lit(0).cast(MONEY))).alias("revenue"),
        )
        .withColumn("campaign", F.concat(F.lit("Campaign "), F.col("channel_id").cast("string")))
    )


def website(spark: SparkSession, folder: str) -> DataFrame:
    """Events per Monday week, channel and device."""
    day = F.to_date("ts")
    channel = _decode("event_type", {"view": 1, "click": 2, "signup": 3, "purchase": 4}, 5).cast("bigint")
    devices = F.array(*map(F.lit, ("mobile", "desktop", "tablet")))
    device = F.element_at(devices, (F.pmod("user_id", F.lit(3)) + 1).cast("int"))
    n = F.count(F.lit(1))
    return (
        table(spark, folder, "events")
        .groupBy(
            dates.date_key(F.date_sub(day, F.weekday(day))).alias("week_date_id"),
            channel.alias("channel_id"),
            device.alias("device"),
        )
        .agg(
            n.alias("sessions"),
            F.countDistinct("user_id").alias("users"),
            F.try_divide(F.count_if(F.col("value") < 10), n).alias("bounce_rate"),
            F.try_divide(F.count_if(F.col("value") > 100), n).alias("conversion_rate"),
        )
        .withColumn("browser", F.lit("Chrome"))
        .withColumn("country", F.lit("United Kingdom"))
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Daily extremes of the line items shipped from a region."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax")
    # Extremes per supplier and day first: the region lookup then sees far fewer rows.
    daily = lines.groupBy("l_suppkey", dates.date_key(F.to_date("l_shipdate")).alias("date_id")).agg(
        F.max("l_quantity").alias("hi"),
        F.min("l_quantity").alias("lo"),
        F.max("l_discount").alias("d"),
        F.max("l_tax").alias("t"),
    )
    guides = dim_guide(spark, folder).select("guide_id", "primary_region_id")
    return (
        lookup(daily, "l_suppkey", guides, "guide_id", {"primary_region_id": "region_id"})
        .groupBy("date_id", "region_id")
        .agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"), F.max("d").alias("d"), F.max("t").alias("t"))
        .select(
            "date_id",
            "region_id",
            (F.col("hi") - 20).alias("temperature_c"),
            F.col("lo").alias("rain_mm"),
            F.col("hi").alias("wind_speed_kmh"),
            ((F.col("d") >= 0.1) & (F.col("t") >= 0.08)).alias("storm_warning"),
        )
    )


def _shared(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    build = {
        "DimDate": dim_date,
        "DimRegion": dim_region,
        "DimGuide": dim_guide,
        "DimRoute": dim_route,
        "DimCustomer": dim_customer,
        "FactPayments": payments,
        "FactEquipmentHire": equipment,
        "FactMarketing": marketing,
        "FactWebsiteAnalytics": website,
        "FactWeather": weather,
    }
    tables = {name: partial(fn, spark, folder) for name, fn in build.items()}
    return tables | {"DimMarketingChannel": partial(dim_marketing_channel, spark)}


def order_star(spark: SparkSession, folder: str, region: bool = True) -> Star:
    """Star schema with one booking per order."""
    return LazyStar(
        _shared(spark, folder)
        | {
            "FactBookings": partial(order_bookings, spark, folder, region),
            "FactReviews": partial(reviews, spark, folder),
        }
    )


def line_star(
    spark: SparkSession, folder: str, region: bool = True, order: bool = False, review_per_line: bool = True
) -> Star:
    """Star schema with one booking per line item."""
    reviewed = line_reviews if review_per_line else reviews
    return LazyStar(
        _shared(spark, folder)
        | {
            "FactBookings": partial(line_bookings, spark, folder, region, order),
            "FactReviews": partial(reviewed, spark, folder),
        }
    )
