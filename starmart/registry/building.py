"""Warehouse builders, sources and sinks over tables derived from the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.numbers import MONEY, count_rows, money
from starmart.operators import ranking
from starmart.plans import reports, snapshots, validation, warehouse
from starmart.registry import ORACLES, messy, query
from starmart.registry.cleansing import CLEANERS, SQL
from starmart.registry.rules import variant, variant_sql
from starmart.registry.sql import over, season, ymd
from starmart.schemas import CHANNELS, CLEAN, DATE_YEAR, EQUIPMENT, STAR
from starmart.session import shared_path
from starmart.sources import files, tpch
from starmart.sources.tpch import table

# ------------------------------------------------------------------ cleaned entities

CHANNEL_OF = {p: CHANNELS[i] for i, p in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))}


def _channel(c: str) -> Column:
    return tpch._decode(c, CHANNEL_OF, CHANNELS[-1])


CHANNEL_SQL = "CASE left(o_orderpriority,1) WHEN '1' THEN 'organic' WHEN '2' THEN 'direct' WHEN '3' THEN 'referral' WHEN '4' THEN 'paid_search' ELSE 'paid_social' END"


def conformed(name: str, df: DataFrame) -> DataFrame:
    return files.conform(df, CLEAN[name])


def regions(spark, sf) -> DataFrame:
    return CLEANERS["Region"](spark, sf).rows


def guides(spark, sf) -> DataFrame:
    return CLEANERS["Guide"](spark, sf).rows


def routes(spark, sf) -> DataFrame:
    """Parts as routes of the five regions; the sixth region name is unknown."""
    spots = ("Africa", "America", "Asia", "Europe", "Middle East", "Nowhere")
    size = F.col("p_size")
    df = table(spark, sf, "part").select(
        F.col("p_partkey").alias("route_id"),
        F.col("p_name").alias("name"),
        variant("p_size", *spots).alias("region"),
        tpch._decode("p_type", {"ECONOMY": "moderate", "SMALL": "moderate", "MEDIUM": "hard", "STANDARD": "hard"}, "advanced").alias("difficulty"),
        size.alias("distance_km"),
        size.alias("duration_hours"),
        size.alias("mountain_height_m"),
        size.alias("elevation_gain_m"),
        (size > 25).alias("is_featured"),
        (size > 5).alias("active"),
        F.lit(55.0).alias("trailhead_lat"),
        F.lit(-3.0).alias("trailhead_lon"),
    )
    return conformed("Route", df)


REGION_IDS = "CASE p_size % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 END"
ROUTE_SQL = f"""SELECT p_partkey AS route_id, p_name AS name, CAST({REGION_IDS} AS BIGINT) AS region_id, CASE WHEN p_type IN ('ECONOMY','SMALL') THEN 'moderate'
    WHEN p_type IN ('MEDIUM','STANDARD') THEN 'hard' ELSE 'advanced' END AS difficulty, p_size::DOUBLE AS distance_km, p_size::DOUBLE AS duration_hours,
    p_size AS mountain_height_m, p_size AS elevation_gain_m, p_size > 25 AS is_featured, p_size > 5 AS active, 55.0::DOUBLE AS trailhead_lat, -3.0::DOUBLE AS trailhead_lon FROM part"""


def tours(spark, sf) -> DataFrame:
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tour_id"),
        F.col("o_custkey").alias("route_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("guide_id"),
        F.to_date("o_orderdate").alias("date"),
        tpch._season(F.col("o_orderdate")).alias("season"),
        F.lit("07:30").alias("start_time"),
        money("o_totalprice").alias("price_pp"),
        F.lit(3).alias("max_group_size"),
        F.lit("open").alias("status"),
    )
    return conformed("ScheduledTour", df)


def bookings(spark, sf) -> DataFrame:
    """Orders as bookings; customers write their address in two ways, or leave it out."""
    owner = F.col("o_custkey").cast("string")
    lead = F.pmod("o_orderkey", F.lit(90)).cast("int")
    price = money("o_totalprice")
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_orderkey").alias("tour_id"),
        F.concat(F.lit("R-"), F.col("o_orderkey").cast("string")).alias("booking_reference"),
        (F.pmod("o_orderkey", F.lit(3)) + 1).alias("party_size"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("Customer "), owner, F.lit(" "), "o_orderpriority")).alias("contact_name"),
        variant(
            "o_custkey",
            F.concat(F.lit("customer."), owner, F.lit("@example.com")),
            F.concat(F.when(F.col("o_orderstatus") == "F", "Customer.").otherwise("customer."), owner, F.lit("@Example.com")),
            F.lit(None),
            F.lit(" "),
        ).alias("contact_email"),
        F.lit(False).alias("contact_email_invalid"),
        F.concat(F.lit("0"), F.col("o_orderkey").cast("string")).alias("contact_phone"),
        F.lit(None).alias("emergency_contact"),
        F.lit(None).alias("notes"),
        tpch._decode("o_orderstatus", {"F": "confirmed", "O": "amended"}, "cancelled").alias("status"),
        price.alias("list_price"),
        F.lit(0.1).alias("discount_pct"),
        F.lit(True).alias("discount_applied"),
        (price * F.lit("0.9").cast("decimal(2,1)")).cast(MONEY).alias("total_price"),
        F.date_sub(F.to_date("o_orderdate"), lead).alias("created_at"),
        F.lit(None).alias("archived_at"),
    )
    return conformed("Booking", df)


BOOKING_SQL = f"""SELECT o_orderkey AS booking_id, o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN 'Customer ' || o_custkey || ' ' || o_orderpriority END AS contact_name,
    CASE WHEN o_custkey % 4 < 2 THEN 'customer.' || o_custkey || '@example.com' END AS email, '0' || o_orderkey AS contact_phone,
    {ymd('o_orderdate')} AS tour_date_id, o_orderdate::DATE - CAST(o_orderkey % 90 AS INTEGER) AS created FROM orders"""
CUSTOMER_SQL = f"""SELECT row_number() OVER (ORDER BY email) AS customer_id, email AS contact_email,
    arg_max(contact_name, (created, booking_id)) FILTER (WHERE contact_name IS NOT NULL) AS contact_name, arg_max(contact_phone, (created, booking_id)) AS contact_phone
    FROM b WHERE email IS NOT NULL GROUP BY email"""


def attribution(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return conformed("BookingAttribution", orders.select(F.col("o_orderkey").alias("booking_id"), _channel("o_orderpriority").alias("channel")))


def payments(spark, sf) -> DataFrame:
    paid = F.when(F.col("event_type").isin("purchase", "view"), F.col("ts"))
    df = table(spark, sf, "events").select(
        F.col("event_id").alias("payment_id"),
        F.col("event_id").alias("booking_id"),
        F.lit("pi").alias("stripe_payment_intent_id"),
        F.lit("cs").alias("stripe_checkout_session_id"),
        F.lit(None).alias("stripe_refund_id"),
        money("value").alias("amount"),
        F.lit("GBP").alias("currency"),
        tpch._decode("event_type", {"purchase": "paid", "view": "refunded", "error": "failed"}, "pending").alias("status"),
        paid.alias("paid_at"),
        F.when(F.col("event_type") == "view", F.col("ts")).alias("refunded_at"),
    )
    return conformed("Payment", df)


def reviews(spark, sf) -> DataFrame:
    return conformed("Review", tpch.reviews(spark, sf))


def equipment(spark, sf) -> DataFrame:
    bought = table(spark, sf, "events").where("event_type = 'purchase'")
    df = bought.select(
        F.col("event_id").alias("booking_id"),
        *[(F.pmod("user_id", F.lit(n)) == 0).alias(item) for n, item in enumerate(EQUIPMENT, start=2)],
        money("value").alias("hire_revenue"),
    )
    return conformed("EquipmentHire", df)


def marketing(spark, sf) -> DataFrame:
    price = money("o_totalprice")
    df = (
        table(spark, sf, "orders")
        .groupBy(_channel("o_orderpriority").alias("channel"), F.trunc(F.to_date("o_orderdate"), "MM").alias("month"))
        .agg(F.max(price).alias("spend"), count_rows().alias("clicks"), F.sum(price).alias("revenue"))
        .select(
            F.concat(F.lit("Campaign "), "channel").alias("campaign"), "channel", "month", "spend", "clicks",
            (F.col("clicks") * 20).alias("impressions"), F.col("clicks").alias("conversions"), "revenue",
        )
    )
    return conformed("Marketing", df)


MARKETING_SQL = f"""SELECT {CHANNEL_SQL} AS channel, date_trunc('month', o_orderdate)::DATE AS month, CAST(max(o_totalprice) AS DOUBLE) AS spend, count(*) AS clicks,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2"""
CHANNEL_IDS = "['organic','direct','referral','paid_search','paid_social','email']"


def website(spark, sf) -> DataFrame:
    names = F.array(*map(F.lit, CHANNELS))
    weekly = tpch.website(spark, sf)
    df = weekly.withColumn("week_starting", dates.key_date("week_date_id")).withColumn(
        "traffic_source", F.element_at(names, F.col("channel_id").cast("int"))
    )
    return conformed("WebsiteAnalytics", df)


def weather(spark, sf) -> DataFrame:
    names = regions(spark, sf).select("region_id", F.col("name").alias("region"))
    df = tpch.weather(spark, sf).join(names, "region_id").select(
        dates.key_date("date_id").alias("date"), "region", "temperature_c", "rain_mm", "wind_speed_kmh",
        F.lit(10.0).alias("visibility_km"), F.lit(0.0).alias("snow_depth_cm"), "storm_warning",
    )
    return conformed("Weather", df)


CLEAN_ENTITIES = {
    "Region": regions,
    "Guide": guides,
    "Route": routes,
    "ScheduledTour": tours,
    "Booking": bookings,
    "Payment": payments,
    "Review": reviews,
    "Weather": weather,
    "BookingAttribution": attribution,
    "Marketing": marketing,
    "WebsiteAnalytics": website,
    "EquipmentHire": equipment,
}


# ------------------------------------------------------------------ dimensions

WEEK0 = "d - dayofweek(d)::INTEGER"


@query(
    "b01_dim_date",
    over(
        "days holidays",
        f"""SELECT {ymd("d")} AS date_id, d AS full_date, day(d) AS day, month(d) AS month, monthname(d) AS month_name, quarter(d) AS quarter, year(d) AS year,
        isodow(d) - 1 AS day_of_week, dayname(d) AS day_name, isodow(d) > 5 AS is_weekend, ['Winter','Spring','Summer','Autumn'][(month(d) % 12) // 3 + 1] AS calendar_season,
        {WEEK0} AS week_start_date, {WEEK0} + 6 AS week_end_date, dense_rank() OVER (PARTITION BY year({WEEK0}) ORDER BY {WEEK0}) AS week_number,
        year({WEEK0}) AS retail_year, d IN (SELECT h.d FROM holidays h) AS is_bank_holiday, strftime(d, '%m%d') BETWEEN '0720' AND '0831' AS is_summer_holiday FROM days""",
    ),
)
def b01(spark, sf):
    return tpch.dim_date(spark, sf)


@query("b02_date_span", over("span", "SELECT lo, hi FROM span"))
def b02(spark, sf):
    return tpch.span(spark, sf)


@query("b03_dim_region", f"WITH {SQL['Region'][0]} {SQL['Region'][1]}")
def b03(spark, sf):
    return warehouse.dim_region(regions(spark, sf))


@query(
    "b04_dim_guide",
    f"""WITH {SQL["Guide"][0]}, g AS ({SQL["Guide"][1]}) SELECT guide_id, first_name, last_name, first_name || ' ' || last_name AS full_name, qualifications, years_experience,
    languages, employment_type, day_rate_gbp, CAST(n_regionkey AS BIGINT) AS primary_region_id, active, discount_tendency_pct
    FROM g JOIN supplier ON guide_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def b04(spark, sf):
    return warehouse.dim_guide(guides(spark, sf), warehouse.dim_region(regions(spark, sf)))


@query("b05_dim_route", ROUTE_SQL)
def b05(spark, sf):
    return warehouse.dim_route(routes(spark, sf), warehouse.dim_region(regions(spark, sf)))


@query("b06_dim_customer", f"WITH b AS ({BOOKING_SQL}) {CUSTOMER_SQL}")
def b06(spark, sf):
    return warehouse.dim_customer(bookings(spark, sf))


@query(
    "b07_dim_marketing_channel",
    over(
        "dim_channel",
        f"""SELECT c.channel_id, channel_name, channel_type, count(o_orderkey) AS bookings FROM dim_channel c
        LEFT JOIN orders ON channel_name = {CHANNEL_SQL} GROUP BY 1, 2, 3""",
    ),
)
def b07(spark, sf):
    used = table(spark, sf, "orders").groupBy(_channel("o_orderpriority").alias("channel_name")).agg(count_rows().alias("n"))
    channels = warehouse.dim_marketing_channel(spark)
    return channels.join(used, "channel_name", "left").select(*channels.columns, F.coalesce("n", F.lit(0)).alias("bookings"))


# ------------------------------------------------------------------ facts


def _dims(spark, sf) -> dict[str, DataFrame]:
    region = warehouse.dim_region(regions(spark, sf))
    return {
        "DimRegion": region,
        "DimRoute": warehouse.dim_route(routes(spark, sf), region),
        "DimCustomer": warehouse.dim_customer(bookings(spark, sf)),
        "DimMarketingChannel": warehouse.dim_marketing_channel(spark),
    }


@query(
    "b08_fact_bookings",
    f"""WITH b AS ({BOOKING_SQL}), c AS ({CUSTOMER_SQL}), r AS ({ROUTE_SQL})
    SELECT o_orderkey AS booking_id, 'R-' || o_orderkey AS booking_reference, o_orderkey AS tour_id, customer_id, o.o_custkey AS route_id,
    CASE WHEN o_orderstatus <> 'P' THEN o.o_custkey END AS guide_id, region_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(left(o_orderpriority,1) AS BIGINT) END AS channel_id,
    tour_date_id, {ymd("created")} AS created_date_id, {season("o_orderdate")} AS season,
    CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'amended' ELSE 'cancelled' END AS status, CAST(o_orderkey % 3 + 1 AS INTEGER) AS party_size,
    CAST(o_totalprice AS DOUBLE) AS list_price, 0.1::DOUBLE AS discount_pct, true AS discount_applied,
    CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.9 AS DECIMAL(18,2)) AS DOUBLE) AS total_price, CAST(o_orderkey % 90 AS INTEGER) AS lead_time_days, false AS contact_email_invalid
    FROM orders o JOIN b ON o_orderkey = booking_id LEFT JOIN c ON b.email = c.contact_email LEFT JOIN r ON r.route_id = o.o_custkey""",
)
def b08(spark, sf):
    clean = {"Booking": bookings(spark, sf), "ScheduledTour": tours(spark, sf), "BookingAttribution": attribution(spark, sf)}
    return warehouse.fact_bookings(clean, _dims(spark, sf))


@query(
    "b08_rejected_bookings",
    f"""WITH r AS ({ROUTE_SQL}) SELECT count(*) FILTER (WHERE ok) AS loaded, count(*) FILTER (WHERE NOT ok) AS rejected FROM
    (SELECT o_custkey % 4 < 2 AND region_id IS NOT NULL AS ok FROM orders LEFT JOIN r ON route_id = o_custkey)""",
)
def b08_rejects(spark, sf):
    clean = {"Booking": bookings(spark, sf), "ScheduledTour": tours(spark, sf), "BookingAttribution": attribution(spark, sf)}
    bookings_by = warehouse.with_outcome(warehouse.fact_bookings(clean, _dims(spark, sf)))
    outcome = F.col("outcome")
    return bookings_by.agg(
        F.count_if(outcome == "loaded").alias("loaded"), F.count_if(outcome == "rejected").alias("rejected")
    )


@query(
    "b09_fact_payments",
    f"""SELECT event_id AS payment_id, event_id AS booking_id, value AS amount, 'GBP' AS currency,
    CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'view' THEN 'refunded' WHEN 'error' THEN 'failed' ELSE 'pending' END AS status,
    CASE WHEN event_type IN ('purchase','view') THEN {ymd("ts")} END AS paid_date_id, CASE WHEN event_type = 'view' THEN {ymd("ts")} END AS refunded_date_id FROM events""",
)
def b09(spark, sf):
    return warehouse.fact_payments(payments(spark, sf))


def _booking_keys(spark, sf) -> DataFrame:
    keys = tpch.order_bookings(spark, sf, region=False).select("booking_id", "customer_id")
    return keys.withColumns({"route_id": F.col("customer_id") * 2, "guide_id": F.col("customer_id") * 3})


@query(
    "b10_fact_reviews",
    over(
        "reviews",
        """SELECT r.* REPLACE (overall_rating::INTEGER AS overall_rating, guide_rating::INTEGER AS guide_rating, route_rating::INTEGER AS route_rating,
        safety_rating::INTEGER AS safety_rating, value_rating::INTEGER AS value_rating, comment_length::INTEGER AS comment_length),
        o_custkey AS customer_id, o_custkey * 2 AS route_id, o_custkey * 3 AS guide_id FROM reviews r LEFT JOIN orders ON booking_id = o_orderkey""",
    ),
)
def b10(spark, sf):
    return warehouse.fact_reviews(reviews(spark, sf), _booking_keys(spark, sf))


@query(
    "b11_fact_equipment_hire",
    """SELECT event_id AS booking_id, o_custkey AS customer_id, user_id % 2 = 0 AS boots, user_id % 3 = 0 AS waterproofs, user_id % 4 = 0 AS poles,
    user_id % 5 = 0 AS helmet, user_id % 6 = 0 AS ice_axe, user_id % 7 = 0 AS crampons, value AS hire_revenue
    FROM events LEFT JOIN orders ON event_id = o_orderkey WHERE event_type = 'purchase'""",
)
def b11(spark, sf):
    return warehouse.fact_equipment_hire(equipment(spark, sf), _booking_keys(spark, sf))


@query(
    "b12_fact_marketing",
    f"""WITH m AS ({MARKETING_SQL}) SELECT row_number() OVER (ORDER BY month, channel_id) AS marketing_id, 'Campaign ' || channel AS campaign, channel_id,
    {ymd("month")} AS month_date_id, spend, clicks, clicks * 20 AS impressions, clicks AS conversions, revenue
    FROM (SELECT *, CAST(list_position({CHANNEL_IDS}, channel) AS BIGINT) AS channel_id FROM m)""",
)
def b12(spark, sf):
    return warehouse.fact_marketing(marketing(spark, sf), warehouse.dim_marketing_channel(spark))


@query(
    "b13_fact_website_analytics",
    over(
        "website",
        f"""SELECT row_number() OVER (ORDER BY week, channel_id, device) AS website_analytics_id, {ymd("week")} AS week_date_id, channel_id, device, sessions, users,
        bounce_rate, conversion_rate, 'Chrome' AS browser, 'United Kingdom' AS country FROM website""",
    ),
)
def b13(spark, sf):
    return warehouse.fact_website_analytics(website(spark, sf), warehouse.dim_marketing_channel(spark))


@query(
    "b14_fact_weather",
    over(
        "weather",
        f"""SELECT row_number() OVER (ORDER BY d, region_id) AS weather_id, {ymd("d")} AS date_id, region_id, temperature_c, rain_mm, temperature_c + 20 AS wind_speed_kmh,
        10.0::DOUBLE AS visibility_km, 0.0::DOUBLE AS snow_depth_cm, storm_warning FROM weather""",
    ),
)
def b14(spark, sf):
    return warehouse.fact_weather(weather(spark, sf), warehouse.dim_region(regions(spark, sf)))


def stored_clean(spark, sf) -> str:
    """All twelve cleaned tables written below the shared folder."""
    folder = shared_path(spark, "clean")
    for name, build in CLEAN_ENTITIES.items():
        files.write_table(build(spark, sf), f"{folder}/{name}")
    return folder


STAR_ROWS = f"""WITH r AS ({ROUTE_SQL}), ok AS (SELECT * FROM orders JOIN r ON route_id = o_custkey WHERE o_custkey % 4 < 2 AND region_id IS NOT NULL),
    span AS (SELECT least((SELECT min(o_orderdate::DATE - CAST(o_orderkey % 90 AS INTEGER)) FROM orders), (SELECT min(l_shipdate)::DATE FROM lineitem),
        (SELECT min(date_trunc('month', o_orderdate))::DATE FROM orders), (SELECT min(date_trunc('week', ts))::DATE FROM events)) AS lo,
      greatest((SELECT max(o_orderdate)::DATE FROM orders), (SELECT max(l_shipdate)::DATE FROM lineitem), (SELECT max(ts)::DATE FROM events WHERE event_type IN ('purchase','view')),
        (SELECT max(date_trunc('week', ts))::DATE FROM events)) AS hi),
    counts AS (SELECT 'DimDate' AS "table", date_diff('day', lo, hi) + 1 AS rows FROM span
    UNION ALL SELECT 'DimRegion', count(*) FROM region UNION ALL SELECT 'DimGuide', count(*) FROM supplier UNION ALL SELECT 'DimRoute', count(*) FROM part
    UNION ALL SELECT 'DimCustomer', count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 4 < 2 UNION ALL SELECT 'DimMarketingChannel', 6
    UNION ALL SELECT 'FactBookings', count(*) FROM ok UNION ALL SELECT 'FactPayments', count(*) FROM events UNION ALL SELECT 'FactReviews', count(*) FROM documents
    UNION ALL SELECT 'FactEquipmentHire', count(*) FROM events WHERE event_type = 'purchase' UNION ALL SELECT 'FactMarketing', count(*) FROM ({MARKETING_SQL})
    UNION ALL SELECT 'FactWebsiteAnalytics', count(DISTINCT (date_trunc('week', ts), event_type, user_id % 3)) FROM events
    UNION ALL SELECT 'FactWeather', count(DISTINCT (l_shipdate, n_regionkey)) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


# One figure of each fact beside its rows; figures come from the statements of the facts themselves.
FIGURES = {
    "FactBookings": ("b08_fact_bookings", "total_price"),
    "FactPayments": ("b09_fact_payments", "amount"),
    "FactReviews": ("b10_fact_reviews", "overall_rating"),
    "FactEquipmentHire": ("b11_fact_equipment_hire", "hire_revenue"),
    "FactMarketing": ("b12_fact_marketing", "spend"),
    "FactWebsiteAnalytics": ("b13_fact_website_analytics", "sessions"),
    "FactWeather": ("b14_fact_weather", "rain_mm"),
}
KEYS_PRESENT = "WHERE customer_id IS NOT NULL AND route_id IS NOT NULL AND region_id IS NOT NULL"
FIGURE_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", round(CAST(sum({c}) AS DOUBLE), 2) AS total FROM ({ORACLES[q]}) {KEYS_PRESENT if t == "FactBookings" else ""}"""
    for t, (q, c) in FIGURES.items()
)


def figures_of(told: DataFrame) -> DataFrame:
    """(table, rows, total) of a manifest: rows of every table, the figure of each fact to the penny."""
    figure = F.create_map(*[F.lit(x) for t, (_, c) in FIGURES.items() for x in (t, c)])[F.col("table")]
    mine = F.max(F.when(F.col("measure") == figure, F.round("total", 2)))
    return told.groupBy("table", "rows").agg(mine.alias("total"))


@query("b15_build_warehouse", f"""{STAR_ROWS} SELECT "table", rows, total FROM counts LEFT JOIN ({FIGURE_SQL}) USING ("table")""")
def b15(spark, sf):
    """What the load's manifest tells of the stored tables."""
    folder = shared_path(spark, "warehouse")
    warehouse.build_warehouse(spark, stored_clean(spark, sf), folder)
    return figures_of(spark.read.parquet(f"{folder}/Manifest"))


# ------------------------------------------------------------------ sources and sinks


@query(
    "s01_scan_raw_csv",
    f"""SELECT event_id // 2 AS payment_id, event_id // 2 AS booking_id, 'pi_' || event_id AS stripe_payment_intent_id, 'cs_' || event_id AS stripe_checkout_session_id,
    CAST(NULL AS VARCHAR) AS stripe_refund_id, {variant_sql("user_id", "'£' || CAST(value AS DECIMAL(18,2))", "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)", "'0'")} AS amount_raw,
    {variant_sql("user_id", "'gbp'", "' GBP'", "' gbp '", "'usd'")} AS currency_raw,
    {messy.spelled_sql("user_id", "CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'error' THEN 'failed' ELSE 'lost' END")} AS status_raw,
    {variant_sql("user_id", "strftime(ts, '%Y-%m-%d %H:%M:%S')", "'unpaid'")} AS paid_at, CAST(NULL AS VARCHAR) AS refunded_at,
    row_number() OVER (ORDER BY event_id) AS line FROM events""",
)
def s01(spark, sf):
    """Files that double in length, scanned with the line number over all of them."""
    folder = shared_path(spark, "raw")
    raw, at = messy.payments(spark, sf), F.col(messy.ORDINAL)
    dealt = raw.repartitionByRange(8, F.floor(F.log2(at + 1))).sortWithinPartitions(at).drop(messy.ORDINAL)
    files.write_csv(dealt, f"{folder}/payments_raw.csv")
    scanned = files.read_raw(spark, folder, "payments")
    return ranking.numbered(scanned, "line", [F.col(messy.ORDINAL)]).drop(messy.ORDINAL)


@query(
    "s02_scan_clean_csv",
    f"""SELECT o_orderkey AS tour_id, o_custkey AS route_id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS guide_id, o_orderdate::DATE AS date,
    {season("o_orderdate")} AS season, '07:30' AS start_time, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price_pp, 3 AS max_group_size, 'open' AS status FROM orders""",
)
def s02(spark, sf):
    path = shared_path(spark, "clean-csv")
    files.write_csv(tours(spark, sf), path)
    return files.read_clean_csv(spark, path, "ScheduledTour")


@query(
    "s04_write_clean_tables",
    f"""WITH {SQL["EquipmentHire"][0]} {SQL["EquipmentHire"][1]}""",
)
def s04(spark, sf):
    folder = shared_path(spark, "clean")
    files.write_table(CLEANERS["EquipmentHire"](spark, sf).frame, f"{folder}/EquipmentHire")
    return files.read_clean(spark, folder, "EquipmentHire")


@query(
    "s05_load_partitioned_fact",
    "SELECT year(o_orderdate) AS year, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS booked FROM orders GROUP BY 1",
)
def s05(spark, sf):
    folder = shared_path(spark, "warehouse")
    facts = files.conform(
        tpch.order_bookings(spark, sf).withColumns(
            {
                "tour_id": F.col("booking_id"),
                "route_id": F.col("customer_id"),
                "guide_id": F.lit(None),
                "list_price": F.col("total_price"),
                "discount_pct": F.lit(0.0),
                "discount_applied": F.lit(False),
                "contact_email_invalid": F.lit(False),
            }
        ),
        STAR["FactBookings"],
    )
    warehouse.load(facts, folder, "FactBookings")
    stored = spark.read.parquet(files.star_path(folder, "FactBookings"))
    return stored.groupBy(F.col(DATE_YEAR).cast("bigint").alias("year")).agg(count_rows().alias("n"), F.sum("total_price").alias("booked"))


@query("s06_full_table_scan", "SELECT * FROM events")
def s06(spark, sf):
    return table(spark, sf, "events")


@query(
    "s07_export_csv",
    f"""{STAR_ROWS}, f AS (SELECT *, o_orderdate::DATE AS d FROM ok),
    w AS (SELECT DISTINCT l_shipdate::DATE AS d, CAST(n_regionkey AS BIGINT) AS region_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
    SELECT "table", rows, total FROM counts LEFT JOIN ({FIGURE_SQL}) USING ("table") UNION ALL SELECT 'Summary_CustomerLTV', count(DISTINCT o_custkey), NULL FROM f
    UNION ALL SELECT 'Summary_GuidePerformance', count(*), NULL FROM supplier UNION ALL SELECT 'Summary_RoutePerformance', count(DISTINCT route_id), NULL FROM f
    UNION ALL SELECT 'Summary_WeatherFlaggedCancellations', count(*), NULL FROM f JOIN w ON f.d = w.d AND f.region_id = w.region_id WHERE o_orderstatus = 'P'""",
)
def s07(spark, sf):
    star = warehouse.build_warehouse(spark, stored_clean(spark, sf), shared_path(spark, "warehouse"))
    folder = shared_path(spark, "export")
    names = warehouse.export_csv(star, folder)
    return figures_of(warehouse.manifest({n: spark.read.csv(f"{folder}/{n}", header=True, inferSchema=True) for n in names}))


SOLD = "sum(total_price) FILTER (WHERE status = 'confirmed')"


@query(
    "s09_registered_views",
    over(
        "lines_fact dim_guide weather marketing",
        f"""SELECT 'vw_bookings_enriched' AS view, count(*) AS rows, CAST(sum(total_price) AS DOUBLE) AS total FROM lines_fact
        UNION ALL SELECT 'vw_monthly_revenue', count(DISTINCT date_trunc('month', tour_date)), CAST({SOLD} AS DOUBLE) FROM lines_fact
        UNION ALL SELECT 'vw_route_performance', count(DISTINCT route_id), CAST({SOLD} AS DOUBLE) FROM lines_fact
        UNION ALL SELECT 'vw_guide_performance', (SELECT count(*) FROM dim_guide), CAST({SOLD} AS DOUBLE) FROM lines_fact
        UNION ALL SELECT 'vw_customer_summary', count(DISTINCT customer_id), CAST({SOLD} AS DOUBLE) FROM lines_fact
        UNION ALL SELECT 'vw_weather_flagged_cancellations', count(*), CAST(count(*) FILTER (WHERE storm_warning OR rain_mm > 15) AS DOUBLE)
          FROM lines_fact f JOIN weather w ON f.region_id = w.region_id AND f.tour_date = w.d WHERE status = 'cancelled'
        UNION ALL SELECT 'vw_marketing_performance', count(*), CAST(sum(spend) AS DOUBLE) FROM marketing""",
    ),
)
def s09(spark, sf):
    """All views, registered twice, each read by its name."""
    star = tpch.line_star(spark, sf, order=True)
    totals = {
        "vw_bookings_enriched": "total_price",
        "vw_monthly_revenue": "revenue",
        "vw_route_performance": "revenue",
        "vw_guide_performance": "revenue",
        "vw_customer_summary": "lifetime_value",
        "vw_weather_flagged_cancellations": "weather_flagged",
        "vw_marketing_performance": "spend",
    }
    names = [n for _ in range(2) for n in reports.register_views(star)]  # the second time replaces the first
    parts = [f"SELECT '{v}' AS view, count(*) AS rows, CAST(sum({totals[v]}) AS DOUBLE) AS total FROM {v}" for v in sorted(set(names))]
    return spark.sql(" UNION ALL ".join(parts))


@query(
    "s11_declared_schemas",
    f"""{STAR_ROWS} SELECT "table", rows, 0 AS mismatched_columns FROM counts""",
)
def s11(spark, sf):
    """Columns of every stored star table against its contract."""
    star = warehouse.build_warehouse(spark, stored_clean(spark, sf), shared_path(spark, "warehouse"))
    parts = [
        star[n].agg(count_rows().alias("rows")).select(
            F.lit(n).alias("table"), "rows", F.lit(len(validation.schema_gaps(star[n], STAR[n]))).alias("mismatched_columns")
        )
        for n in warehouse.LOAD_ORDER
    ]
    return reduce(DataFrame.unionByName, parts)


@query("s12_refresh_snapshot", "SELECT count(DISTINCT o_custkey) AS customers_refreshed FROM orders")
def s12(spark, sf):
    path = shared_path(spark, "ltv")
    star = tpch.order_star(spark, sf, region=False)
    reports.refresh_customer_ltv_snapshot(spark, star, path)
    return reports.refresh_customer_ltv_snapshot(spark, star, path)


@query(
    "s12_snapshot_rows",
    """SELECT o_custkey AS customer_id, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS lifetime_value,
    count(*) AS total_bookings FROM orders GROUP BY 1""",
)
def s12_rows(spark, sf):
    path = shared_path(spark, "ltv")
    reports.refresh_customer_ltv_snapshot(spark, tpch.order_star(spark, sf, region=False), path)
    return snapshots.current(spark, path).drop("last_refreshed")
