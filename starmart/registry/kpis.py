"""KPI measures, each under a different slice of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.plans import measures, reports
from starmart.registry import query
from starmart.registry.sql import div, over
from starmart.sources import tpch

O, L = "orders_fact", "lines_fact"
CONFIRMED = "count(*) FILTER (WHERE status = 'confirmed')"
CANCELLED = "count(*) FILTER (WHERE status = 'cancelled')"
REVENUE = "CAST(sum(total_price) FILTER (WHERE status = 'confirmed') AS DOUBLE)"


def order_star(spark, sf, region=False):
    return tpch.order_star(spark, sf, region=region)


def line_star(spark, sf, region=False, order=False):
    return tpch.line_star(spark, sf, region=region, order=order)


def _measure(key: str, sql: str, star, name: str, by=(), filters=None, role: str = "tour") -> None:
    @query(key, sql)
    def run(spark, sf):
        return measures.measure(star(spark, sf), name, by, filters, role)


def simple(key: str, fact: str, name: str, sql_value: str, by: str = "", by_sql: str = "", extra: str = "", where: str = "",
           filters=None, region: bool = False) -> None:
    """A measure over one bookings grain, optionally by one attribute."""
    head = f"{by_sql} AS {by}, " if by else ""
    group = " GROUP BY 1" if by else ""
    sql = over(f"{fact} {extra.split(':')[0]}".strip(), f"SELECT {head}{sql_value} AS {name} FROM {fact}{extra.split(':')[1] if ':' in extra else ''}{where}{group}")
    star = (lambda s, d: order_star(s, d, region)) if fact == O else (lambda s, d: line_star(s, d, region))
    _measure(key, sql, star, name, [by] if by else [], filters)


REGION = "dim_region: JOIN dim_region USING (region_id)"
ROUTE = "dim_route: JOIN dim_route USING (route_id)"
GUIDE = "dim_guide: JOIN dim_guide USING (guide_id)"
CHANNEL = "dim_channel: JOIN dim_channel USING (channel_id)"

simple("m01_total_bookings", O, "total_bookings", "count(*)", "year", "year(tour_date)")
simple("m02_confirmed_bookings", O, "confirmed_bookings", CONFIRMED, "quarter", "quarter(tour_date)")
simple("m03_cancelled_bookings", O, "cancelled_bookings", CANCELLED, "region", "name", REGION, region=True)
simple("m04_revenue", O, "revenue", REVENUE, "region", "name", REGION, region=True)
simple("m05_cancellation_rate", L, "cancellation_rate", div(CANCELLED, "count(*)"), "difficulty", "difficulty", ROUTE)
simple("m06_average_booking_value", O, "average_booking_value", div("sum(total_price) FILTER (WHERE status = 'confirmed')", CONFIRMED), "channel", "channel_name", CHANNEL)
simple("m07_guide_days_worked", L, "guide_days_worked", "count(DISTINCT tour_date) FILTER (WHERE status <> 'cancelled')", "guide", "full_name", GUIDE)
simple("m18_revenue_per_guide_day", L, "revenue_per_guide_day",
       div("sum(total_price) FILTER (WHERE status = 'confirmed')", "count(DISTINCT tour_date) FILTER (WHERE status <> 'cancelled')"), "guide", "full_name", GUIDE)
simple("m15_total_customers", O, "total_customers", "count(DISTINCT customer_id)", "year", "year(tour_date)")
simple("m23_guide_utilisation", L, "guide_utilisation",
       div("count(DISTINCT tour_date) FILTER (WHERE status <> 'cancelled')", "date_diff('day', min(tour_date), max(tour_date)) + 1"), "guide_id", "guide_id")
simple("m25_bookings_with_discount_pct", L, "bookings_with_discount_pct", div("count(*) FILTER (WHERE discount_applied)", "count(*)"), "guide", "full_name", GUIDE)
simple("m26_average_discount_pct", L, "average_discount_pct",
       div("sum(CAST(discount_pct AS DECIMAL(9,4))) FILTER (WHERE discount_applied)", "count(*) FILTER (WHERE discount_applied)"), "guide", "full_name", GUIDE)
simple("m27_total_discount_given", L, "total_discount_given", "CAST(sum(list_price - total_price) AS DOUBLE)", "season", "season")
simple("m28_occupancy_pct", O, "occupancy_pct", div("sum(party_size) FILTER (WHERE status = 'confirmed')", f"3 * {CONFIRMED}"), "month", "month(tour_date)")
simple("m35_discount_pct_of_revenue", L, "discount_pct_of_revenue", div("sum(list_price - total_price)", "sum(list_price)"), "year", "year(tour_date)")
simple("m39_average_price_per_tour", L, "average_price_per_tour", div("sum(total_price)", CONFIRMED), "difficulty", "difficulty", ROUTE)
simple("m51_by_season", O, "revenue", REVENUE, "season", "season")
simple("m51_by_route", L, "revenue", REVENUE, "route", "name", ROUTE)
simple("m51_by_week", O, "revenue", REVENUE, "week_start_date", "tour_date - dayofweek(tour_date)::INTEGER")
simple("m51_by_lead_time", O, "confirmed_bookings", CONFIRMED, "lead_time_bucket",
       "CASE WHEN lead_time_days > 90 THEN '90+ days' WHEN lead_time_days > 30 THEN '31-90 days' WHEN lead_time_days > 7 THEN '8-30 days' ELSE '0-7 days' END")
simple("m51_by_experience", L, "revenue", REVENUE, "experience_band",
       "CASE WHEN years_experience < 5 THEN 'Junior (<5 yrs)' WHEN years_experience < 15 THEN 'Experienced (5-15 yrs)' ELSE 'Veteran (15+ yrs)' END", GUIDE)
simple("m51_filtered_by_year_and_region", O, "revenue", REVENUE, "month", "month(tour_date)", REGION, " WHERE name = 'ASIA' AND year(tour_date) IN (1997, 1998)",
       {"region": "ASIA", "year": [1997, 1998]}, region=True)


@query(
    "m51_by_day_of_week",
    over(O, f"SELECT dayname(tour_date) AS day_name, isodow(tour_date) - 1 AS day_of_week, {REVENUE} AS revenue, count(*) AS total_bookings FROM orders_fact GROUP BY 1, 2"),
)
def m51_day(spark, sf):
    return measures.measures(order_star(spark, sf), ["revenue", "total_bookings"], ["day_name", "day_of_week"])


COST = """(SELECT {by}, sum(day_rate_gbp) AS cost FROM (SELECT DISTINCT {by}, guide_id, tour_date FROM lines_fact {join} WHERE status <> 'cancelled') JOIN dim_guide USING (guide_id) GROUP BY 1)"""


@query(
    "m08_guide_cost",
    over("lines_fact dim_guide", "SELECT season, CAST(cost AS DOUBLE) AS guide_cost FROM " + COST.format(by="season", join="")),
)
def m08(spark, sf):
    return measures.measure(line_star(spark, sf), "guide_cost", ["season"])


@query("m09_equipment_hire_revenue", over("equipment", "SELECT CAST(sum(hire_revenue) AS DOUBLE) AS equipment_hire_revenue FROM equipment"))
def m09(spark, sf):
    return measures.measure(order_star(spark, sf), "equipment_hire_revenue")


HIRE = "(SELECT year(tour_date) AS year, sum(hire_revenue) AS hire, count(*) AS hires FROM equipment JOIN orders_fact USING (booking_id) GROUP BY 1)"
SOLD = "(SELECT year(tour_date) AS year, sum(total_price) FILTER (WHERE status = 'confirmed') AS rev, count(*) FILTER (WHERE status = 'confirmed') AS confirmed FROM orders_fact GROUP BY 1)"


@query(
    "m10_total_revenue",
    over("orders_fact equipment", f"SELECT year, CAST(coalesce(rev, 0) + coalesce(hire, 0) AS DOUBLE) AS total_revenue FROM {SOLD} FULL JOIN {HIRE} USING (year)"),
)
def m10(spark, sf):
    return measures.measure(order_star(spark, sf), "total_revenue", ["year"])


PROFIT = """SELECT coalesce(sum(total_price) FILTER (WHERE status = 'confirmed'), 0) + (SELECT sum(hire_revenue) FROM equipment) AS income,
    (SELECT sum(day_rate_gbp) FROM (SELECT DISTINCT guide_id, tour_date FROM lines_fact WHERE status <> 'cancelled') JOIN dim_guide USING (guide_id)) AS cost FROM lines_fact"""


@query("m11_net_profit", over("lines_fact equipment dim_guide", f"SELECT CAST(income - cost AS DOUBLE) AS net_profit FROM ({PROFIT})"))
def m11(spark, sf):
    return measures.measure(line_star(spark, sf), "net_profit")


@query(
    "m12_net_profit_margin",
    over("lines_fact equipment dim_guide", f"SELECT {div('income - cost', 'income')} AS net_profit_margin FROM ({PROFIT})"),
)
def m12(spark, sf):
    return measures.measure(line_star(spark, sf), "net_profit_margin")


@query(
    "m13_average_satisfaction",
    over(
        "orders_fact reviews",
        f"SELECT season, {div('sum(overall_rating)', 'count(overall_rating)')} AS average_satisfaction FROM reviews JOIN orders_fact USING (booking_id) GROUP BY 1",
    ),
)
def m13(spark, sf):
    return measures.measure(order_star(spark, sf), "average_satisfaction", ["season"])


REPEAT = "(SELECT {by}, customer_id, count(*) FILTER (WHERE status IN ('confirmed','amended')) AS trips FROM orders_fact{where} GROUP BY 1, 2)"


@query(
    "m14_repeat_customers",
    over(O, f"SELECT year, count(*) FILTER (WHERE trips > 1) AS repeat_customers FROM {REPEAT.format(by='year(tour_date) AS year', where='')} GROUP BY 1"),
)
def m14(spark, sf):
    return measures.measure(order_star(spark, sf), "repeat_customers", ["year"])


@query(
    "m16_repeat_customer_rate",
    over(O, f"SELECT year, {div('count(*) FILTER (WHERE trips > 1)', 'count(*)')} AS repeat_customer_rate FROM {REPEAT.format(by='year(tour_date) AS year', where='')} GROUP BY 1"),
)
def m16(spark, sf):
    return measures.measure(order_star(spark, sf), "repeat_customer_rate", ["year"])


# Trips are counted over all statuses, customers where they have a booking of the status.
TRIPS_IN_YEAR = """, trips AS (SELECT customer_id, year(tour_date) AS year, count(*) FILTER (WHERE status IN ('confirmed', 'amended')) AS n FROM orders_fact GROUP BY ALL),
    held AS (SELECT DISTINCT o.status, year(o.tour_date) AS year, o.customer_id, n FROM orders_fact o JOIN trips t ON t.customer_id = o.customer_id AND t.year = year(o.tour_date))"""


@query(
    "m14_repeat_customers_by_status",
    over(O, f"{TRIPS_IN_YEAR} SELECT year, status, count(*) FILTER (WHERE n > 1) AS repeat_customers, count(*) AS total_customers FROM held GROUP BY ALL"),
)
def m14_by_status(spark, sf):
    return measures.measures(order_star(spark, sf), ["repeat_customers", "total_customers"], ["year", "status"])


@query(
    "m16_repeat_rate_of_cancelling_customers",
    over(O, f"{TRIPS_IN_YEAR} SELECT year, {div('count(*) FILTER (WHERE n > 1)', 'count(*)')} AS repeat_customer_rate FROM held WHERE status = 'cancelled' GROUP BY ALL"),
)
def m16_cancelled(spark, sf):
    return measures.measure(order_star(spark, sf), "repeat_customer_rate", ["year"], {"status": "cancelled"})


@query(
    "m51_season_slicer_dashboard",
    over(
        "orders_fact marketing",
        f""", sold AS (SELECT year(tour_date) AS year, {REVENUE} AS revenue, count(*) AS total_bookings FROM orders_fact WHERE season = 'winter' GROUP BY ALL),
        spent AS (SELECT year(month) AS year, CAST(sum(spend) AS DOUBLE) AS marketing_spend, CAST(sum(conversions) AS BIGINT) AS marketing_conversions FROM marketing GROUP BY ALL)
        SELECT year, revenue, total_bookings, marketing_spend, marketing_conversions FROM sold FULL JOIN spent USING (year)""",
    ),
)
def m51_slicer(spark, sf):
    """Bookings follow the season; campaigns have none, so the slicer passes them by."""
    names = ["revenue", "total_bookings", "marketing_spend", "marketing_conversions"]
    return measures.measures(order_star(spark, sf), names, ["year"], {"season": "winter"})


@query(
    "m51_split_that_reaches_one_fact",
    over(
        "orders_fact dim_region marketing",
        """, booked AS (SELECT name AS region, year(tour_date) AS year, count(*) AS total_bookings FROM orders_fact JOIN dim_region USING (region_id) GROUP BY ALL),
        won AS (SELECT year(month) AS year, CAST(sum(conversions) AS BIGINT) AS marketing_conversions FROM marketing GROUP BY ALL)
        SELECT region, year, total_bookings, marketing_conversions FROM booked LEFT JOIN won USING (year)""",
    ),
)
def m51_split(spark, sf):
    star = order_star(spark, sf, region=True)
    return measures.measures(star, ["total_bookings", "marketing_conversions"], ["region", "year"])


@query(
    "m17_revenue_vs_last_year",
    over(
        "orders_fact dim_region",
        f""", m AS (SELECT year(tour_date) AS year, month(tour_date) AS month, name AS region, {REVENUE} AS revenue FROM orders_fact JOIN dim_region USING (region_id) GROUP BY 1, 2, 3)
        SELECT a.*, b.revenue AS revenue_last_year, CAST(CAST(a.revenue AS DECIMAL(28,2)) - CAST(b.revenue AS DECIMAL(28,2)) AS DOUBLE) / NULLIF(b.revenue, 0) AS revenue_growth FROM m a
        LEFT JOIN m b ON b.year = a.year - 1 AND b.month = a.month AND b.region = a.region WHERE a.year IN (1998, 1999)""",
    ),
)
def m17(spark, sf):
    return measures.revenue_vs_last_year(order_star(spark, sf, region=True), ["month"], ["region"], {"year": [1998, 1999]})


@query(
    "m19_revenue_year_to_date",
    over(
        O,
        """SELECT year(day) AS year, day AS full_date, CAST(rev AS DOUBLE) AS revenue, CAST(sum(rev) OVER (PARTITION BY year(day) ORDER BY day) AS DOUBLE) AS revenue_ytd
        FROM (SELECT tour_date AS day, coalesce(sum(total_price) FILTER (WHERE status = 'confirmed'), 0) AS rev FROM orders_fact GROUP BY 1)""",
    ),
)
def m19(spark, sf):
    return measures.revenue_year_to_date(order_star(spark, sf))


@query(
    "m20_bank_holiday_uplift",
    over(
        "orders_fact days holidays",
        f""", s AS (SELECT tour_date IN (SELECT h.d FROM holidays h) AS bh, sum(total_price) FILTER (WHERE status = 'confirmed') AS rev FROM orders_fact GROUP BY 1),
        n AS (SELECT d IN (SELECT h.d FROM holidays h) AS bh, count(*) AS days FROM days GROUP BY 1),
        p AS (SELECT bh, {div("rev", "days")} AS per_day FROM s JOIN n USING (bh))
        SELECT max(per_day) FILTER (WHERE bh) / max(per_day) FILTER (WHERE NOT bh) - 1 AS bank_holiday_uplift FROM p""",
    ),
)
def m20(spark, sf):
    return measures.bank_holiday_uplift(order_star(spark, sf))


@query(
    "m21_new_customers",
    over(O, "SELECT year(first) AS year, month(first) AS month, count(*) AS new_customers FROM (SELECT customer_id, min(tour_date) AS first FROM orders_fact GROUP BY 1) GROUP BY 1, 2"),
)
def m21(spark, sf):
    return measures.measure(order_star(spark, sf), "new_customers", ["year", "month"])


@query(
    "m22_reviews_per_confirmed_booking",
    over("orders_fact reviews", f"SELECT {div('(SELECT count(*) FROM reviews)', CONFIRMED)} AS reviews_per_confirmed_booking FROM orders_fact"),
)
def m22(spark, sf):
    return measures.measure(order_star(spark, sf), "reviews_per_confirmed_booking")


@query(
    "m24_guide_performance_index",
    over(
        "lines_fact reviews",
        f""", g AS (SELECT guide_id, sum(total_price) FILTER (WHERE status = 'confirmed') AS rev, {div(CANCELLED, "count(*)")} AS cancel FROM lines_fact GROUP BY 1),
        v AS (SELECT guide_id, {div("sum(guide_rating)", "count(guide_rating) * 5")} AS rating FROM lines_fact JOIN reviews USING (booking_id) GROUP BY 1)
        SELECT guide_id, 0.4::DOUBLE * coalesce({div("rev", "(SELECT sum(rev) FROM g)")}, 0) + 0.4::DOUBLE * coalesce(rating, 0) + 0.2::DOUBLE * (1 - cancel) AS performance_index
        FROM g LEFT JOIN v USING (guide_id)""",
    ),
)
def m24(spark, sf):
    return measures.guide_performance_index(line_star(spark, sf))


MARKETING = (
    ("m29_marketing_spend", "marketing_spend", "CAST(sum(spend) AS DOUBLE)"),
    ("m29_marketing_revenue", "marketing_revenue", "CAST(sum(revenue) AS DOUBLE)"),
    ("m29_marketing_conversions", "marketing_conversions", "CAST(sum(conversions) AS BIGINT)"),
    ("m30_return_on_spend", "return_on_spend", div("sum(revenue)", "sum(spend)")),
    ("m31_acquisition_cost", "acquisition_cost", div("sum(spend)", "sum(conversions)")),
    ("m42_conversion_rate", "conversion_rate", div("sum(conversions)", "sum(clicks)")),
    ("m43_cost_per_booking", "cost_per_booking", div("sum(spend)", "sum(conversions)")),
)
for _key, _name, _value in MARKETING:
    _sql = over("marketing dim_channel", f"SELECT channel_name AS channel, {_value} AS {_name} FROM marketing JOIN dim_channel USING (channel_id) GROUP BY 1")
    _measure(_key, _sql, order_star, _name, ["channel"])


@query(
    "m32_equipment_hire_rate",
    over("orders_fact equipment", f"SELECT year, {div('hires', 'confirmed')} AS equipment_hire_rate FROM {SOLD} LEFT JOIN {HIRE} USING (year)"),
)
def m32(spark, sf):
    return measures.measure(order_star(spark, sf), "equipment_hire_rate", ["year"])


@query(
    "m33_storm_warning_days",
    over("weather dim_region", "SELECT name AS region, count(*) FILTER (WHERE storm_warning) AS storm_warning_days FROM weather JOIN dim_region USING (region_id) GROUP BY 1"),
)
def m33(spark, sf):
    return measures.measure(order_star(spark, sf), "storm_warning_days", ["region"])


FLAGGED = "EXISTS (SELECT 1 FROM weather w WHERE w.region_id = f.region_id AND w.d = f.tour_date AND (storm_warning OR rain_mm > 15))"


@query(
    "m34_weather_flagged_cancellation_rate",
    over(
        "lines_fact weather",
        f"""SELECT year(tour_date) AS year, {div("count(*) FILTER (WHERE flagged)", "count(*)")} AS weather_flagged_cancellation_rate
        FROM (SELECT tour_date, {FLAGGED} AS flagged FROM lines_fact f WHERE status = 'cancelled') GROUP BY 1""",
    ),
)
def m34(spark, sf):
    return measures.measure(line_star(spark, sf, region=True), "weather_flagged_cancellation_rate", ["year"])


@query(
    "m35_gross_margin",
    over(
        "lines_fact dim_guide",
        f"""SELECT season, CAST(rev - cost AS DOUBLE) AS gross_margin FROM (SELECT season, coalesce(sum(total_price) FILTER (WHERE status = 'confirmed'), 0) AS rev FROM lines_fact GROUP BY 1)
        JOIN {COST.format(by="season", join="")} USING (season)""",
    ),
)
def m35(spark, sf):
    return measures.measure(line_star(spark, sf), "gross_margin", ["season"])


PAYMENTS = (
    ("m36_refund_pct", "refund_pct", div("count(*) FILTER (WHERE status = 'refunded')", "count(*) FILTER (WHERE status = 'paid')")),
    ("m37_payment_success_rate", "payment_success_rate", div("count(*) FILTER (WHERE status = 'paid')", "count(*) FILTER (WHERE status IN ('paid','failed'))")),
    ("m38_outstanding_balance", "outstanding_balance", "CAST(sum(amount) FILTER (WHERE status = 'pending') AS DOUBLE)"),
    ("m40_average_days_to_refund", "average_days_to_refund",
     div("sum(date_diff('day', paid_date, refunded_date)) FILTER (WHERE status = 'refunded')", "count(paid_date) FILTER (WHERE status = 'refunded')")),
)
for _key, _name, _value in PAYMENTS:
    _measure(_key, over("payments", f"SELECT {_value} AS {_name} FROM payments"), order_star, _name)


@query(
    "m40_days_to_refund_by_refund_month",
    over(
        "payments",
        f"""SELECT month(refunded_date) AS month, {div("sum(date_diff('day', paid_date, refunded_date))", "count(*)")} AS average_days_to_refund,
        count(*) AS refunds FROM payments WHERE status = 'refunded' GROUP BY 1""",
    ),
)
def m40_month(spark, sf):
    base = measures.figures(order_star(spark, sf), ["refund_days", "refund_n", "refunded"], ["month"], {}, "refunded").where("month IS NOT NULL")
    average = measures.MEASURES["average_days_to_refund"].value()
    return base.select("month", average.alias("average_days_to_refund"), F.col("refunded").alias("refunds"))


@query(
    "m37_payment_success_by_paid_year",
    over(
        "payments",
        f"""SELECT year(paid_date) AS year, {div("count(*) FILTER (WHERE status = 'paid')", "count(*) FILTER (WHERE status IN ('paid', 'failed'))")} AS payment_success_rate
        FROM payments GROUP BY ALL""",
    ),
)
def m37_by_year(spark, sf):
    return measures.measure(order_star(spark, sf), "payment_success_rate", ["year"], date_role="paid")


@query(
    "m48_website_sessions_by_year",
    over("website", "SELECT year(week) AS year, CAST(sum(sessions) AS BIGINT) AS website_sessions FROM website GROUP BY ALL"),
)
def m48_by_year(spark, sf):
    return measures.measure(order_star(spark, sf), "website_sessions", ["year"])


@query(
    "m44_channel_mix_pct",
    over("orders_fact dim_channel", f"SELECT channel_name AS channel, count(*) AS total_bookings, {div('count(*)', '(SELECT count(*) FROM orders_fact)')} AS channel_mix FROM orders_fact JOIN dim_channel USING (channel_id) GROUP BY 1"),
)
def m44(spark, sf):
    return measures.channel_mix_pct(order_star(spark, sf))


@query(
    "m45_customer_lifetime_value",
    over(O, "SELECT customer_id, CAST(sum(CASE WHEN status = 'confirmed' THEN total_price ELSE 0 END) AS DOUBLE) AS lifetime_value, count(*) AS total_bookings FROM orders_fact GROUP BY 1"),
)
def m45(spark, sf):
    return reports.customer_ltv(order_star(spark, sf))


@query(
    "m46_acquisition_by_channel",
    over(
        "orders_fact dim_channel",
        """SELECT channel_name AS channel, count(*) AS customers_acquired FROM (SELECT customer_id, arg_min(channel_id, (tour_date, booking_id)) AS channel_id
        FROM orders_fact GROUP BY 1) JOIN dim_channel USING (channel_id) GROUP BY 1""",
    ),
)
def m46(spark, sf):
    return measures.acquisition_by_channel(order_star(spark, sf))


@query(
    "m47_reviews_per_customer",
    over("orders_fact reviews", f"SELECT {div('(SELECT count(*) FROM reviews)', 'count(DISTINCT customer_id)')} AS reviews_per_customer FROM orders_fact"),
)
def m47(spark, sf):
    return measures.measure(order_star(spark, sf), "reviews_per_customer")


@query(
    "m48_website_traffic",
    over(
        "website dim_channel",
        """SELECT channel_name AS channel, device, CAST(sum(sessions) AS BIGINT) AS website_sessions, CAST(sum(users) AS BIGINT) AS website_users,
        round(avg(bounce_rate), 9) AS average_bounce_rate, round(avg(conversion_rate), 9) AS average_conversion_rate FROM website JOIN dim_channel USING (channel_id) GROUP BY 1, 2""",
    ),
)
def m48(spark, sf):
    names = ["website_sessions", "website_users", "average_bounce_rate", "average_conversion_rate"]
    out = measures.measures(order_star(spark, sf), names, ["channel", "device"])
    return out.withColumns({c: F.round(c, 9) for c in names[2:]})


@query(
    "m_dashboard_executive",
    over(
        "orders_fact reviews",
        f"""SELECT year(tour_date) AS year, count(*) AS total_bookings, {REVENUE} AS revenue, {div(CANCELLED, "count(*)")} AS cancellation_rate,
        {div("sum(total_price) FILTER (WHERE status = 'confirmed')", CONFIRMED)} AS average_booking_value, count(DISTINCT customer_id) AS total_customers,
        {div("sum(overall_rating)", "count(overall_rating)")} AS average_satisfaction FROM orders_fact LEFT JOIN reviews USING (booking_id) GROUP BY 1""",
    ),
)
def dashboard(spark, sf):
    names = ["total_bookings", "revenue", "cancellation_rate", "average_booking_value", "total_customers", "average_satisfaction"]
    return measures.measures(order_star(spark, sf), names, ["year"])


