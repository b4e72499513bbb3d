"""Raw, messy entity tables derived from the driver tables, as frames and as SQL.

They have the columns of the raw CSV files; repeated lines, split keys and
conversation turns supply real duplicates, dangling keys real orphans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.numbers import money
from starmart.operators.lookup import lookup
from starmart.plans.cleaning import ORDINAL
from starmart.registry.rules import COUNTRY_SPELLINGS, quoted, variant, variant_sql
from starmart.sources.tpch import table

TIE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
       "l_linestatus"]
TIE_SQL = ", ".join(TIE)


def spelled(key: str, c: Column) -> Column:
    """Upper case, padded lower case and plain spellings of a word."""
    return variant(key, F.upper(c), F.concat(F.lit(" "), F.lower(c), F.lit("  ")), c)


def spelled_sql(key: str, c: str) -> str:
    return variant_sql(key, f"upper({c})", f"' ' || lower({c}) || '  '", c)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows over many tasks, as raw files come in many splits; a driver table is one row group, so one task.

    A table with splits for every core stays as it is.
    """
    many = df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism
    return df if many else df.repartition(*keys)


#: Rows of a raw file, about.
ROWS_A_FILE = 500_000


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """The rows in the order of the columns, over four tasks or as many as the rows need."""
    parts = max(4, math.ceil(df.count() / ROWS_A_FILE))
    return df.repartitionByRange(parts, *order).sortWithinPartitions(*order)


# ------------------------------------------------------------------ reference data


def regions(spark, sf) -> DataFrame:
    """One line per nation, so every region is delivered five times."""
    named = lookup(table(spark, sf, "nation"), "n_regionkey", table(spark, sf, "region"), "r_regionkey", {"r_name": "r"})
    return named.select(
        F.col("n_regionkey").cast("bigint").alias("region_id"),
        spelled("n_nationkey", F.col("r")).alias("region_name_raw"),
        F.col("n_nationkey").alias(ORDINAL),
    )


REGIONS = f"""SELECT CAST(n_regionkey AS BIGINT) AS region_id, {spelled_sql("n_nationkey", "r_name")} AS region_name_raw,
    n_nationkey AS ord, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"""


def guides(spark, sf) -> DataFrame:
    """Suppliers, delivered twice; the second delivery has no qualifications."""
    base = lookup(
        table(spark, sf, "supplier"),
        "s_nationkey",
        lookup(table(spark, sf, "nation"), "n_regionkey", table(spark, sf, "region"), "r_regionkey", {"r_name": "r"}),
        "n_nationkey",
        {"r": "r"},
    )
    rate = F.abs(money("s_acctbal")).cast("string")
    twice = base.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.select(
        F.col("s_suppkey").alias("guide_id"),
        spelled("s_suppkey", F.lit("o'neil-smith")).alias("first_name_raw"),
        spelled("s_nationkey", F.col("s_name")).alias("last_name_raw"),
        F.when((F.col("copy") == 0) & (F.col("s_nationkey") > 5), F.lit("ML; WML")).alias("qualifications_raw"),
        F.floor(F.abs("s_acctbal") / 100).cast("int").alias("years_experience"),
        F.lit("English; Welsh").alias("languages_raw"),
        variant("s_suppkey", "Employed", " FREELANCE ", "volunteer").alias("employment_type"),
        variant("s_suppkey", F.concat(F.lit("£"), rate), F.concat(F.lit("GBP "), rate), rate).alias("day_rate_gbp_raw"),
        spelled("s_nationkey", F.col("r")).alias("primary_region_raw"),
        (F.col("s_acctbal") >= 0).alias("active"),
        (F.floor(F.abs("s_acctbal") / 300) / 100).cast("double").alias("discount_tendency_pct"),
        (F.col("s_suppkey") * 2 + F.col("copy")).alias(ORDINAL),
    )


GUIDES = f"""SELECT s_suppkey AS guide_id, {spelled_sql("s_suppkey", "'o''neil-smith'")} AS first_name_raw,
    {spelled_sql("s_nationkey", "s_name")} AS last_name_raw, CASE WHEN s_nationkey > 5 THEN 'ML; WML' END AS qualifications_raw,
    CAST(floor(abs(s_acctbal) / 100) AS INTEGER) AS years_experience, s_suppkey % 3 AS e,
    abs(CAST(s_acctbal AS DECIMAL(18,2))) AS rate, r_name, s_acctbal >= 0 AS active,
    floor(abs(s_acctbal) / 300) / 100.0::DOUBLE AS tendency FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def routes(spark, sf) -> DataFrame:
    size = F.col("p_size")
    km = (size + F.lit(0.5)).cast("string")
    level = (
        F.when(F.col("p_type") == "ECONOMY", "moderate").when(F.col("p_type") == "SMALL", "hard")
        .when(F.col("p_type") == "MEDIUM", "advanced").otherwise("extreme")
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("route_id"),
        spelled("p_partkey", F.concat(F.col("p_name"), F.lit(" jack's rake"))).alias("route_name_raw"),
        spelled("p_size", F.lit("peak district")).alias("region_name_raw"),
        spelled("p_partkey", level).alias("difficulty_raw"),
        variant("p_partkey", F.concat(km, F.lit(" km")), km, F.lit("unknown")).alias("distance_km_raw"),
        (size / 4).cast("double").alias("duration_hours"),
        (size * 20).alias("mountain_height_m"),
        F.when(size > 12, (size * 25 + 0.5).cast("double")).alias("elevation_gain_m_raw"),
        (size > 40).alias("is_featured"),
        (size > 5).alias("active"),
        (49 + size * F.lit(0.25)).cast("double").alias("trailhead_lat"),
        (-9 + size * F.lit(0.25)).cast("double").alias("trailhead_lon"),
        F.col("p_partkey").alias(ORDINAL),
    )


ROUTES = """SELECT p_partkey AS route_id, p_name, p_size, p_partkey % 3 AS v, CASE p_type WHEN 'ECONOMY' THEN 'moderate' WHEN 'SMALL' THEN 'hard'
    WHEN 'MEDIUM' THEN 'advanced' ELSE 'extreme' END AS difficulty, CASE WHEN p_size > 12 THEN p_size * 25 + 0.5::DOUBLE END AS elevation,
    49 + p_size * 0.25::DOUBLE AS lat, -9 + p_size * 0.25::DOUBLE AS lon FROM part"""


# ------------------------------------------------------------------ transactions


def scheduled_tours(spark, sf) -> DataFrame:
    price = money("o_totalprice").cast("string")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tour_id"),
        F.col("o_orderkey").alias("route_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("double")).alias("guide_id"),
        F.to_date("o_orderdate").alias("date"),
        spelled("o_orderkey", F.when(F.month("o_orderdate") > 6, "winter").otherwise("summer")).alias("season"),
        F.lit(" 07:30\t").alias("start_time_raw"),
        variant("o_custkey", F.concat(F.lit("£"), price), price, F.lit("-5.00"), F.lit("tbc")).alias("price_pp_raw"),
        (F.pmod("o_orderkey", F.lit(4)) + 1).cast("int").alias("max_group_size"),
        spelled("o_custkey", F.lit("open")).alias("status_raw"),
        F.col("o_orderdate").alias(ORDINAL),
    )


TOURS = f"""SELECT o_orderkey AS tour_id, o_orderkey AS route_id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS guide_id,
    o_orderdate::DATE AS date, CASE WHEN month(o_orderdate) > 6 THEN 'winter' ELSE 'summer' END AS season, '07:30' AS start_time,
    CASE o_custkey % 4 WHEN 2 THEN CAST(-5 AS DECIMAL(18,2)) WHEN 3 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price_pp,
    CAST(o_orderkey % 4 + 1 AS INTEGER) AS max_group_size, 'open' AS status FROM orders"""


def bookings(spark, sf, ordered: bool = False) -> DataFrame:
    """Line items; a quarter of them repeat a (order, line) pair and so a booking reference.

    ``ordered``: in the order of the ordinal, which the narrow lines are dealt out by.
    """
    lines = table(spark, sf, "lineitem")
    lines = in_order(lines, *TIE) if ordered else spread(lines, "l_orderkey", "l_linenumber")
    listed = money("l_extendedprice")
    net = (listed * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    total = F.when(F.col("l_tax") >= 0.08, net + F.lit("0.05").cast("decimal(18,2)")).otherwise(net)
    key = F.col("l_suppkey").cast("string")
    day = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
        (F.col("l_orderkey") + 100).alias("tour_id"),
        F.concat(F.lit("R-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "booking_reference"
        ),
        F.floor(F.col("l_quantity") / 13).cast("int").alias("party_size"),
        spelled("l_partkey", F.lit("ann-marie o'hara")).alias("contact_name_raw"),
        variant(
            "l_suppkey",
            F.concat(F.lit("guest."), key, F.lit("@example.com")),
            F.concat(F.lit(" guest."), key, F.lit(" at example.com")),
            F.lit("nobody"),
            F.lit(None),
        ).alias("contact_email_raw"),
        F.concat(F.lit(" 0"), key, F.lit(" ")).alias("contact_phone_raw"),
        F.when(F.col("l_tax") > 0.04, spelled("l_partkey", F.lit("next of kin"))).alias("emergency_contact_raw"),
        F.lit(None).cast("string").alias("notes_raw"),
        spelled("l_partkey", F.when(F.col("l_returnflag") == "A", "confirmed").when(F.col("l_returnflag") == "N", "pending")
                .otherwise("refused")).alias("status_raw"),
        F.concat(F.lit("£"), F.format_number(listed, 2)).alias("list_price_raw"),
        F.col("l_discount").alias("discount_pct"),
        (F.col("l_tax") > 0.02).alias("discount_applied"),
        F.concat(F.lit("GBP "), total.cast("string")).alias("total_price_raw"),
        day.alias("created_at"),
        variant("l_suppkey", day, F.lit(None), F.lit("never")).alias("archived_at"),
        F.struct(*TIE).alias(ORDINAL),
    )


NET_SQL = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))"
BOOKINGS = f"""SELECT l_orderkey * 10 + l_linenumber AS booking_id, l_orderkey + 100 AS tour_id, 'R-' || l_orderkey || '-' || l_linenumber AS booking_reference,
    CAST(floor(l_quantity / 13) AS INTEGER) AS party_size, 'Ann-Marie O''Hara' AS contact_name,
    CASE l_suppkey % 4 WHEN 0 THEN 'guest.' || l_suppkey || '@example.com' WHEN 1 THEN 'guest.' || l_suppkey || '@example.com' WHEN 2 THEN 'nobody' END AS contact_email,
    l_suppkey % 4 > 1 AS contact_email_invalid, l_suppkey % 4 = 1 AS repaired, '0' || l_suppkey AS contact_phone,
    CASE WHEN l_tax > 0.04 THEN 'Next Of Kin' END AS emergency_contact, CAST(NULL AS VARCHAR) AS notes,
    CASE l_returnflag WHEN 'A' THEN 'confirmed' WHEN 'N' THEN 'pending' ELSE 'refused' END AS status,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS list_price, l_discount AS discount_pct, l_tax > 0.02 AS discount_applied,
    CASE WHEN l_tax >= 0.08 THEN {NET_SQL} + 0.05 ELSE {NET_SQL} END AS total_price, l_shipdate AS created_at,
    CASE WHEN l_suppkey % 3 = 0 THEN l_shipdate END AS archived_at,
    CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS expected,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {TIE_SQL}) AS rn FROM lineitem"""


def payments(spark, sf) -> DataFrame:
    """Events paid per pair: every payment id is delivered twice."""
    amount = money("value").cast("string")
    status = F.when(F.col("event_type") == "purchase", "paid").when(F.col("event_type") == "error", "failed").otherwise("lost")
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 2).alias("payment_id"),
        F.floor(F.col("event_id") / 2).alias("booking_id"),
        F.concat(F.lit("pi_"), F.col("event_id").cast("string")).alias("stripe_payment_intent_id"),
        F.concat(F.lit("cs_"), F.col("event_id").cast("string")).alias("stripe_checkout_session_id"),
        F.lit(None).cast("string").alias("stripe_refund_id"),
        variant("user_id", F.concat(F.lit("£"), amount), amount, F.lit("0")).alias("amount_raw"),
        variant("user_id", "gbp", " GBP", " gbp ", "usd").alias("currency_raw"),
        spelled("user_id", status).alias("status_raw"),
        variant("user_id", moment, F.lit("unpaid")).alias("paid_at"),
        F.lit(None).cast("string").alias("refunded_at"),
        F.col("event_id").alias(ORDINAL),
    )


PAYMENTS = """SELECT event_id // 2 AS payment_id, event_id // 2 AS booking_id, 'pi_' || event_id AS stripe_payment_intent_id, 'cs_' || event_id AS stripe_checkout_session_id,
    CAST(NULL AS VARCHAR) AS stripe_refund_id, CASE user_id % 3 WHEN 2 THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END AS amount,
    CASE WHEN user_id % 4 = 3 THEN 'USD' ELSE 'GBP' END AS currency, CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'error' THEN 'failed' ELSE 'lost' END AS status,
    CASE WHEN user_id % 2 = 0 THEN date_trunc('second', ts) END AS paid_at, CAST(NULL AS TIMESTAMP) AS refunded_at, user_id,
    row_number() OVER (PARTITION BY event_id // 2 ORDER BY event_id) AS rn FROM events"""


# ------------------------------------------------------------------ extensions


def reviews(spark, sf) -> DataFrame:
    """Conversation turns: the first turn of a conversation is its review."""
    n = F.length("text")
    rating = F.when(F.col("role") != "system", F.pmod(n, F.lit(7)).cast("double"))
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("booking_id"),
        rating.alias("overall_rating"),
        (F.pmod(n, F.lit(5)) + 1).cast("double").alias("guide_rating"),
        F.when(n > 50, F.lit(4.0)).alias("route_rating"),
        F.lit(5.0).alias("safety_rating"),
        F.lit(None).cast("double").alias("value_rating"),
        n.alias("comment_length"),
        variant("conv_id", "YES", " no", "perhaps").alias("would_recommend_raw"),
        F.struct("turn", "role", "text").alias(ORDINAL),
    )


REVIEWS = """SELECT conv_id AS booking_id, CASE WHEN role <> 'system' THEN CAST(length(text) % 7 AS INTEGER) END AS overall_rating,
    CAST(length(text) % 5 + 1 AS INTEGER) AS guide_rating, CASE WHEN length(text) > 50 THEN 4 END AS route_rating, 5 AS safety_rating, CAST(NULL AS INTEGER) AS value_rating,
    CAST(length(text) AS INTEGER) AS comment_length, CASE conv_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS would_recommend,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations"""


def weather(spark, sf, ordered: bool = False) -> DataFrame:
    """One observation per line item; several share a day and region under different spellings.

    ``ordered``: in the order of the ordinal, which the narrow lines are dealt out by.
    """
    lines = lookup(table(spark, sf, "lineitem"), "l_suppkey", table(spark, sf, "supplier"), "s_suppkey", {"s_nationkey": "nation"})
    lines = lookup(lines, "nation", table(spark, sf, "nation"), "n_nationkey", {"n_regionkey": "region_key"})
    lines = lookup(lines, "region_key", table(spark, sf, "region"), "r_regionkey", {"r_name": "r"})
    order = ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", *[c for c in TIE if c not in ("l_suppkey", "l_partkey")]]
    if ordered:
        lines = in_order(lines, *order)
    name = F.when(F.col("nation") == 24, "Atlantis").otherwise(F.initcap("r"))
    q = F.col("l_quantity")
    return lines.select(
        F.to_date("l_shipdate").alias("date"),
        spelled("l_suppkey", name).alias("region_raw"),
        (q - 20).alias("temperature_c"),
        (q - 3).alias("rain_mm"),
        q.alias("wind_speed_kmh"),
        F.lit(10.0).alias("visibility_km"),
        F.lit(0.0).alias("snow_depth_cm"),
        (F.col("l_tax") >= 0.08).alias("storm_warning"),
        F.struct(*order).alias(ORDINAL),
    )


WEATHER_TIE = ", ".join(["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"] + [c for c in TIE if c not in ("l_suppkey", "l_partkey")])
INITCAP_REGION = "array_to_string(list_transform(string_split(r_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
WEATHER = f"""SELECT l_shipdate::DATE AS date, CASE WHEN n_nationkey = 24 THEN 'Atlantis' ELSE {INITCAP_REGION} END AS region,
    l_quantity - 20 AS temperature_c, l_quantity - 3 AS rain_mm, l_quantity AS wind_speed_kmh, 10.0::DOUBLE AS visibility_km, 0.0::DOUBLE AS snow_depth_cm,
    l_tax >= 0.08 AS storm_warning, row_number() OVER (PARTITION BY l_shipdate::DATE, CASE WHEN n_nationkey = 24 THEN 'Atlantis' ELSE r_name END ORDER BY {WEATHER_TIE}) AS rn
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CHANNEL_SPELLINGS = ("Organic", " direct ", "REFERRAL", "paid_search", "Paid_Social", "email", "billboard")


def attribution(spark, sf) -> DataFrame:
    """Orders attributed per pair: every booking id is delivered twice."""
    return table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 2).alias("booking_id"),
        variant("o_custkey", *CHANNEL_SPELLINGS).alias("channel_raw"),
        F.col("o_orderkey").alias(ORDINAL),
    )


ATTRIBUTION = f"""SELECT o_orderkey // 2 AS booking_id, {variant_sql("o_custkey", *[quoted(c.strip().lower()) for c in CHANNEL_SPELLINGS])} AS channel,
    row_number() OVER (PARTITION BY o_orderkey // 2 ORDER BY o_orderkey) AS rn FROM orders"""


def marketing(spark, sf) -> DataFrame:
    spend = money("c_acctbal").cast("string")
    return table(spark, sf, "customer").select(
        spelled("c_custkey", F.concat(F.lit("search - "), F.col("c_mktsegment"))).alias("campaign_raw"),
        variant("c_custkey", *CHANNEL_SPELLINGS).alias("channel_raw"),
        variant("c_nationkey", "2024-01", "2024-12", "2023-06").alias("year_month"),
        variant("c_nationkey", F.concat(F.lit("£"), spend), spend).alias("spend_raw"),
        F.col("c_custkey").alias("clicks"),
        (F.col("c_custkey") * 20).alias("impressions"),
        F.col("c_nationkey").cast("bigint").alias("conversions"),
        F.lit("£1,133.78").alias("revenue_raw"),
    )


MARKETING = f"""SELECT 'Search - ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS campaign, {variant_sql("c_custkey", *[quoted(c.strip().lower()) for c in CHANNEL_SPELLINGS])} AS channel,
    CASE c_nationkey % 3 WHEN 0 THEN DATE '2024-01-01' WHEN 1 THEN DATE '2024-12-01' ELSE DATE '2023-06-01' END AS month,
    CAST(c_acctbal AS DECIMAL(18,2)) AS spend, c_custkey AS clicks, c_custkey * 20 AS impressions, CAST(c_nationkey AS BIGINT) AS conversions, CAST(1133.78 AS DOUBLE) AS revenue FROM customer"""


def website(spark, sf) -> DataFrame:
    value = F.col("value")
    return table(spark, sf, "events").select(
        F.to_date("ts").alias("week_starting"),
        spelled("user_id", F.col("event_type")).alias("traffic_source_raw"),
        variant("event_id", "Mobile", " desktop", "TABLET ", "watch").alias("device_raw"),
        F.col("event_id").alias("sessions"),
        F.col("user_id").alias("users"),
        (value / 100 - 0.1).alias("bounce_rate"),
        F.when(F.col("event_type") != "error", value / 300).alias("conversion_rate"),
        F.lit("Chrome").alias("browser"),
        variant("event_id", *COUNTRY_SPELLINGS).alias("country_raw"),
    )


COUNTRY_SQL = variant_sql("event_id", *[quoted(c) for c in ["United Kingdom"] * 5 + ["United States"] * 5 + ["Germany"] * 3 + ["France"] * 2 + ["Ireland"] * 3 + ["Neverland", None]])
RAW_COUNTRY_SQL = variant_sql("event_id", *[quoted(c) for c in COUNTRY_SPELLINGS])
WEBSITE = f"""SELECT ts::DATE AS week_starting, event_type AS traffic_source, {variant_sql("event_id", "'mobile'", "'desktop'", "'tablet'", "'watch'")} AS device,
    event_id AS sessions, user_id AS users, greatest(0, least(1, value / 100 - 0.1)) AS bounce_rate,
    CASE WHEN event_type <> 'error' THEN least(1, value / 300) END AS conversion_rate, 'Chrome' AS browser, {COUNTRY_SQL} AS country,
    {RAW_COUNTRY_SQL} AS country_raw, event_id FROM events"""


def equipment(spark, sf) -> DataFrame:
    """Events hired per pair: every booking id is delivered twice."""
    revenue = (money("value") - F.lit(2)).cast("string")
    answers = ("Yes", "NO", " y ", "0", "unsure")
    return table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 2).alias("booking_id"),
        variant("user_id", *answers).alias("boots_raw"),
        variant("event_id", *answers).alias("waterproofs_raw"),
        F.lit("yes").alias("poles_raw"),
        F.lit("No").alias("helmet_raw"),
        F.lit(None).cast("string").alias("ice_axe_raw"),
        F.lit("TRUE").alias("crampons_raw"),
        variant("user_id", F.concat(F.lit("£"), revenue), revenue).alias("hire_revenue_raw"),
        F.col("event_id").alias(ORDINAL),
    )


def _answer(key: str) -> str:
    return variant_sql(key, "true", "false", "true", "false", "NULL")


EQUIPMENT = f"""SELECT event_id // 2 AS booking_id, {_answer("user_id")} AS boots, {_answer("event_id")} AS waterproofs, true AS poles, false AS helmet,
    CAST(NULL AS BOOLEAN) AS ice_axe, true AS crampons, CAST(value AS DECIMAL(18,2)) - 2 AS hire_revenue,
    row_number() OVER (PARTITION BY event_id // 2 ORDER BY event_id) AS rn FROM events"""
