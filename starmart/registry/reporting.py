"""Reporting views, analytical queries, parameterised reports, insights and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.operators import intervals
from starmart.plans import insights, reports
from starmart.registry import query
from starmart.registry.shapes import MEMBERS_SQL, members
from starmart.registry.sql import div, over, rate, rnd
from starmart.sources import tpch
from starmart.sources.tpch import table

CONFIRMED = "CAST(sum(CASE WHEN status = 'confirmed' THEN total_price ELSE 0 END) AS DOUBLE)"
CANCELLED = "count(*) FILTER (WHERE status = 'cancelled')"


# ------------------------------------------------------------------ views


@query(
    "rv1_bookings_enriched",
    over(
        "lines_fact dim_customer dim_route dim_region dim_guide dim_channel",
        """SELECT f.booking_id, 'L-' || f.booking_id AS booking_reference, f.status, f.party_size, CAST(f.total_price AS DOUBLE) AS total_price,
        date_diff('day', created_date, tour_date) AS lead_time_days, f.season, tour_date, year(tour_date) AS tour_year, month(tour_date) AS tour_month,
        monthname(tour_date) AS tour_month_name, quarter(tour_date) AS tour_quarter, isodow(tour_date) > 5 AS tour_is_weekend, created_date,
        f.customer_id, contact_name, contact_email, f.route_id, t.name AS route_name, difficulty, distance_km, f.region_id, r.name AS region_name,
        f.guide_id, full_name AS guide_name, channel_name AS marketing_channel
        FROM lines_fact f JOIN dim_customer USING (customer_id) JOIN dim_route t ON f.route_id = t.route_id JOIN dim_region r ON f.region_id = r.region_id
        LEFT JOIN dim_guide g ON f.guide_id = g.guide_id LEFT JOIN dim_channel c ON f.channel_id = c.channel_id""",
    ),
)
def rv1(spark, sf):
    return reports.stored_enriched(tpch.line_star(spark, sf, order=True))


@query(
    "rv2_monthly_revenue",
    over(
        "orders_fact",
        f"""SELECT year(tour_date) AS tour_year, month(tour_date) AS tour_month, monthname(tour_date) AS tour_month_name, count(*) AS bookings,
        {CONFIRMED} AS revenue, {CANCELLED} AS cancellations, {rate(CANCELLED, "count(*)")} AS cancellation_rate FROM orders_fact GROUP BY 1, 2, 3""",
    ),
)
def rv2(spark, sf):
    return reports.monthly_revenue(tpch.order_star(spark, sf, region=False))


@query(
    "rv3_route_performance",
    over(
        "lines_fact dim_route dim_region reviews",
        f"""SELECT f.route_id, t.name AS route_name, r.name AS region_name, t.difficulty, count(*) AS bookings, {CONFIRMED} AS revenue,
        {rate(CANCELLED, "count(*)")} AS cancellation_rate, {rate("sum(overall_rating)", "count(overall_rating)", 2)} AS avg_overall_rating
        FROM lines_fact f JOIN dim_route t USING (route_id) JOIN dim_region r ON t.region_id = r.region_id LEFT JOIN reviews v ON f.booking_id = v.booking_id
        GROUP BY 1, 2, 3, 4""",
    ),
)
def rv3(spark, sf):
    return reports.route_performance(tpch.line_star(spark, sf, region=False))


@query(
    "rv4_guide_performance",
    over(
        "lines_fact dim_guide reviews",
        f"""SELECT g.guide_id, full_name, employment_type, CAST(day_rate_gbp AS DOUBLE) AS day_rate_gbp, count(f.booking_id) AS bookings, {CONFIRMED} AS revenue,
        {rate("count(*) FILTER (WHERE status = 'cancelled')", "count(f.booking_id)")} AS cancellation_rate,
        {rate("sum(guide_rating)", "count(guide_rating)", 2)} AS avg_guide_rating, {rate("sum(safety_rating)", "count(safety_rating)", 2)} AS avg_safety_rating
        FROM dim_guide g LEFT JOIN lines_fact f ON g.guide_id = f.guide_id LEFT JOIN reviews v ON f.booking_id = v.booking_id GROUP BY 1, 2, 3, 4""",
    ),
)
def rv4(spark, sf):
    return reports.guide_performance(tpch.line_star(spark, sf, region=False))


@query(
    "rv5_customer_summary",
    over(
        "orders_fact dim_customer",
        f"""SELECT c.customer_id, contact_name, contact_email, count(booking_id) AS total_bookings, {CONFIRMED} AS lifetime_value,
        min(tour_date) AS first_booking_date, max(tour_date) AS last_booking_date, CASE WHEN count(booking_id) > 1 THEN 1 ELSE 0 END AS is_repeat_customer
        FROM dim_customer c JOIN orders_fact f ON c.customer_id = f.customer_id GROUP BY 1, 2, 3""",
    ),
)
def rv5(spark, sf):
    return reports.customer_summary(tpch.order_star(spark, sf, region=False))


FLAG = "CASE WHEN storm_warning OR rain_mm > 15 THEN 1 ELSE 0 END"


@query(
    "rv6_weather_flagged_cancellations",
    over(
        "lines_fact weather dim_route dim_region",
        f"""SELECT f.booking_id, t.name AS route_name, r.name AS region_name, tour_date, storm_warning, rain_mm, {FLAG} AS weather_flagged
        FROM lines_fact f JOIN weather w ON f.region_id = w.region_id AND f.tour_date = w.d JOIN dim_route t ON f.route_id = t.route_id
        JOIN dim_region r ON f.region_id = r.region_id WHERE status = 'cancelled'""",
    ),
)
def rv6(spark, sf):
    return reports.weather_flagged_cancellations(tpch.line_star(spark, sf))


@query(
    "rv7_marketing_performance",
    over(
        "marketing dim_channel",
        f""", monthly AS (SELECT channel_id, month, sum(spend) AS s, sum(revenue) AS r, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS impressions,
          CAST(sum(conversions) AS BIGINT) AS conversions FROM marketing GROUP BY ALL)
        SELECT c.channel_name, c.channel_type, year(m.month) AS year, month(m.month) AS month, CAST(s AS DOUBLE) AS spend, clicks, impressions, conversions, CAST(r AS DOUBLE) AS revenue,
        {rate("r", "greatest(s, 0)", 2)} AS roas, ifnull({rate("s", "greatest(conversions, 0)", 2)}, 0) AS cost_per_booking
        FROM monthly m, dim_channel c WHERE c.channel_id = m.channel_id""",
    ),
)
def rv7(spark, sf):
    return reports.marketing_performance(tpch.order_star(spark, sf, region=False))


# ------------------------------------------------------------------ analytical queries


@query(
    "rq1_revenue_by_region",
    over(
        "orders_fact dim_region",
        f"""SELECT name AS region, count(*) AS total_bookings, {CONFIRMED} AS revenue,
        {rate("sum(total_price) FILTER (WHERE status = 'confirmed')", "count(*) FILTER (WHERE status = 'confirmed')", 2)} AS avg_booking_value,
        {CANCELLED} AS cancellations, {rate(CANCELLED, "count(*)")} AS cancellation_rate
        FROM orders_fact JOIN dim_region USING (region_id) GROUP BY 1 HAVING count(*) >= 100 ORDER BY revenue DESC""",
    ),
)
def rq1(spark, sf):
    return reports.revenue_by_region(tpch.order_star(spark, sf))


@query(
    "rq2_top_routes_by_region",
    over(
        "lines_fact dim_route dim_region",
        """, sold AS (SELECT region_id, route_id, sum(total_price) AS total, count(*) AS bookings FROM lines_fact WHERE status = 'confirmed' GROUP BY ALL),
        named AS (SELECT r.name AS region, t.name AS route, t.difficulty, sum(s.total) AS total, CAST(sum(s.bookings) AS BIGINT) AS bookings
          FROM sold s, dim_route t, dim_region r WHERE t.route_id = s.route_id AND r.region_id = s.region_id GROUP BY ALL),
        placed AS (SELECT n.*, 1 + (SELECT count(*) FROM named m WHERE m.region = n.region AND m.total > n.total) AS revenue_rank FROM named n)
        SELECT region, route, difficulty, CAST(total AS DOUBLE) AS revenue, bookings, revenue_rank FROM placed WHERE revenue_rank < 4""",
    ),
)
def rq2(spark, sf):
    return reports.top_routes_by_region(tpch.line_star(spark, sf))


@query(
    "rq3_guide_leaderboard",
    over(
        "lines_fact dim_guide dim_region reviews",
        f"""SELECT r.name AS primary_region, full_name, count(f.booking_id) AS bookings, {CONFIRMED} AS revenue,
        {rate("sum(overall_rating)", "count(overall_rating)", 2)} AS avg_rating,
        {rate("count(*) FILTER (WHERE status = 'cancelled')", "count(f.booking_id)")} AS cancellation_rate,
        row_number() OVER (PARTITION BY r.name ORDER BY {CONFIRMED} DESC, g.guide_id) AS region_revenue_rank
        FROM dim_guide g JOIN dim_region r ON g.primary_region_id = r.region_id LEFT JOIN lines_fact f ON g.guide_id = f.guide_id
        LEFT JOIN reviews v ON f.booking_id = v.booking_id WHERE g.active GROUP BY g.guide_id, 1, 2""",
    ),
)
def rq3(spark, sf):
    return reports.guide_leaderboard(tpch.line_star(spark, sf, region=False))


@query(
    "rq4_month_over_month_growth",
    over(
        "orders_fact",
        f""", m AS (SELECT year(tour_date) AS year, month(tour_date) AS month, monthname(tour_date) AS month_name, {CONFIRMED} AS revenue FROM orders_fact GROUP BY 1, 2, 3),
        p AS (SELECT *, lag(revenue) OVER (ORDER BY year, month) AS prior_month_revenue FROM m)
        SELECT *, {rnd("100 * (revenue - prior_month_revenue) / NULLIF(prior_month_revenue, 0)", 1)} AS mom_growth_pct FROM p ORDER BY year, month""",
    ),
)
def rq4(spark, sf):
    return reports.month_over_month_growth(tpch.order_star(spark, sf, region=False))


TRIP_PAIRS = """SELECT o_custkey AS customer_id, o_orderdate::DATE AS booking_date,
    lead(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_booking_date FROM orders WHERE o_orderstatus IN ('F','O')"""


@query(
    "rq5_repeat_customer_intervals",
    f"""SELECT customer_id, c_name AS contact_name, booking_date, next_booking_date, date_diff('day', booking_date, next_booking_date) AS days_to_next_booking
    FROM ({TRIP_PAIRS}) JOIN customer ON c_custkey = customer_id WHERE next_booking_date IS NOT NULL
    ORDER BY days_to_next_booking, customer_id, booking_date LIMIT 50""",
)
def rq5(spark, sf):
    return reports.repeat_customer_intervals(tpch.order_star(spark, sf, region=False))


@query(
    "rq5_all_rebooking_gaps",
    f"""SELECT customer_id, booking_date, next_booking_date, date_diff('day', booking_date, next_booking_date) AS days_to_next_booking, count(*) AS pairs
    FROM ({TRIP_PAIRS}) WHERE next_booking_date IS NOT NULL GROUP BY ALL""",
)
def rq5_all(spark, sf):
    return reports.rebooking_gaps(tpch.order_star(spark, sf, region=False))


@query(
    "rq6_cancellation_drivers",
    over(
        "lines_fact weather dim_region",
        f"""SELECT r.name AS region, monthname(tour_date) AS month_name, count(*) AS total_cancellations,
        count(*) FILTER (WHERE storm_warning OR rain_mm > 15) AS weather_flagged_cancellations,
        {rate("count(*) FILTER (WHERE storm_warning OR rain_mm > 15)", "count(*)")} AS weather_flagged_share,
        CASE WHEN month(tour_date) IN (11,12,1,2,3) THEN 'Winter season' ELSE 'Summer season' END AS season_bucket
        FROM lines_fact f JOIN dim_region r ON f.region_id = r.region_id LEFT JOIN weather w ON f.region_id = w.region_id AND f.tour_date = w.d
        WHERE status = 'cancelled' GROUP BY 1, 2, season_bucket""",
    ),
)
def rq6(spark, sf):
    return reports.cancellation_drivers(tpch.line_star(spark, sf))


@query(
    "rq7_marketing_channel_mix",
    over(
        "marketing dim_channel",
        """, monthly AS (SELECT channel_id, month, CAST(sum(conversions) AS BIGINT) AS n, CAST(sum(spend) AS DOUBLE) AS spent, CAST(sum(revenue) AS DOUBLE) AS earned
          FROM marketing GROUP BY ALL)
        SELECT c.channel_name, c.channel_type, year(m.month) AS year, month(m.month) AS month, ifnull(n, 0) AS conversions, ifnull(spent, 0) AS spend, ifnull(earned, 0) AS revenue
        FROM dim_channel c LEFT JOIN monthly m ON m.channel_id = c.channel_id""",
    ),
)
def rq7(spark, sf):
    return reports.channel_mix(tpch.order_star(spark, sf, region=False))


# Each customer's first two days with a trip decide; later ones add nothing.
TRIP_DAYS = """SELECT o_custkey AS customer_id, list_sort(list(DISTINCT o_orderdate::DATE)) AS days FROM orders
    WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL"""


@query(
    "rq8_cohort_retention",
    over(
        "span",
        f""", gaps AS (SELECT strftime(days[1], '%Y-%m') AS cohort_month, days[2] - days[1] AS gap FROM ({TRIP_DAYS})),
        last AS (SELECT strftime((date_trunc('month', hi) - INTERVAL 13 MONTH)::DATE + (day(hi) - 1)::INTEGER, '%Y-%m') AS cohort_month FROM span)
        SELECT g.cohort_month, count(*) AS cohort_size, count(*) FILTER (WHERE gap <= 182) AS rebooked_6m, count(*) FILTER (WHERE gap <= 365) AS rebooked_12m,
        {rate("count(*) FILTER (WHERE gap <= 182)", "count(*)")} AS retention_6m, {rate("count(*) FILTER (WHERE gap <= 365)", "count(*)")} AS retention_12m
        FROM gaps g SEMI JOIN last l ON g.cohort_month <= l.cohort_month GROUP BY ALL""",
    ),
)
def rq8(spark, sf):
    return reports.cohort_retention(tpch.order_star(spark, sf, region=False))


@query(
    "rq9_confirmed_revenue_by_region",
    over(
        "lines_fact dim_region",
        """SELECT name AS region, CAST(sum(total_price) AS DOUBLE) AS revenue, count(*) AS bookings FROM lines_fact JOIN dim_region USING (region_id)
        WHERE status = 'confirmed' GROUP BY 1""",
    ),
)
def rq9(spark, sf):
    return reports.confirmed_revenue_by_region(tpch.line_star(spark, sf))


# ------------------------------------------------------------------ parameterised reports


@query(
    "rp1_guide_performance_report",
    over(
        "lines_fact dim_guide reviews",
        f"""SELECT full_name, 1998 AS report_year, count(*) FILTER (WHERE status = 'confirmed') AS bookings, {CONFIRMED} AS revenue,
        {rate("sum(guide_rating)", "count(guide_rating)", 2)} AS avg_guide_rating FROM dim_guide g
        LEFT JOIN lines_fact f ON g.guide_id = f.guide_id AND year(tour_date) = 1998 LEFT JOIN reviews v ON f.booking_id = v.booking_id
        WHERE g.guide_id = 7 GROUP BY 1""",
    ),
)
def rp1(spark, sf):
    return reports.guide_performance_report(tpch.line_star(spark, sf, region=False, review_per_line=False), guide_id=7, year=1998)


@query(
    "rp1_report_of_a_year_without_bookings",
    over("dim_guide", "SELECT full_name, 2019 AS report_year, 0 AS bookings, 0.0::DOUBLE AS revenue, CAST(NULL AS DOUBLE) AS avg_guide_rating FROM dim_guide WHERE guide_id = 3"),
)
def rp1_idle(spark, sf):
    return reports.guide_performance_report(tpch.line_star(spark, sf, region=False, review_per_line=False), guide_id=3, year=2019)


@query("rp2_refresh_customer_ltv_snapshot", "SELECT count(DISTINCT o_custkey) AS customers_refreshed FROM orders")
def rp2(spark, sf):
    from starmart.session import shared_path

    return reports.refresh_customer_ltv_snapshot(spark, tpch.order_star(spark, sf, region=False), shared_path(spark, "ltv"))


@query(
    "rp3_route_performance_report",
    over(
        "lines_fact dim_route reviews",
        f"""SELECT name, difficulty, count(f.booking_id) AS bookings, {CONFIRMED} AS revenue, {rate("sum(overall_rating)", "count(overall_rating)", 2)} AS avg_rating
        FROM dim_route t LEFT JOIN lines_fact f ON t.route_id = f.route_id LEFT JOIN reviews v ON f.booking_id = v.booking_id WHERE t.route_id = 42 GROUP BY 1, 2""",
    ),
)
def rp3(spark, sf):
    return reports.route_performance_report(tpch.line_star(spark, sf, region=False, review_per_line=False), route_id=42)


# ------------------------------------------------------------------ insights


@query(
    "ri01_yearly_revenue_growth",
    over(
        "orders_fact",
        f""", y AS (SELECT year(tour_date) AS year, {CONFIRMED} AS revenue FROM orders_fact GROUP BY 1)
        SELECT a.year, a.revenue, b.revenue AS prior_year_revenue, {rnd("100 * (a.revenue - b.revenue) / b.revenue", 1)} AS yoy_pct FROM y a LEFT JOIN y b ON b.year = a.year - 1""",
    ),
)
def ri01(spark, sf):
    return insights.yearly_revenue(tpch.order_star(spark, sf, region=False))


@query(
    "ri02_revenue_by_day_type",
    over(
        "orders_fact holidays",
        f""", d AS (SELECT tour_date, sum(total_price) AS rev FROM orders_fact WHERE status = 'confirmed' GROUP BY 1),
        t AS (SELECT CASE WHEN tour_date IN (SELECT h.d FROM holidays h) THEN 'bank_holiday' WHEN isodow(tour_date) > 5 THEN 'weekend' ELSE 'weekday' END AS day_type,
          count(*) AS days, sum(rev)::DOUBLE / count(*) AS a FROM d GROUP BY 1)
        SELECT day_type, days, {rnd("a", 2)} AS avg_revenue, {rnd("a / (SELECT a FROM t WHERE day_type = 'weekday')", 2)} AS multiple_of_weekday FROM t""",
    ),
)
def ri02(spark, sf):
    return insights.revenue_by_day_type(tpch.order_star(spark, sf, region=False))


@query(
    "ri03_region_concentration",
    over(
        "orders_fact dim_region",
        f""", r AS (SELECT name AS region, {CONFIRMED} AS revenue, count(*) AS bookings FROM orders_fact JOIN dim_region USING (region_id) GROUP BY 1)
        SELECT *, {rnd("revenue / (SELECT sum(revenue) FROM r)", 4)} AS revenue_share,
        {rnd("(SELECT sum(revenue) FROM (SELECT revenue FROM r ORDER BY revenue DESC LIMIT 2)) / (SELECT sum(revenue) FROM r)", 4)} AS top_regions_share FROM r""",
    ),
)
def ri03(spark, sf):
    return insights.region_concentration(tpch.order_star(spark, sf))


@query(
    "ri04_difficulty_profile",
    over(
        "lines_fact dim_route reviews",
        f"""SELECT difficulty, {rate("sum(overall_rating)", "count(overall_rating)", 2)} AS avg_rating, {rate(CANCELLED, "count(*)")} AS cancellation_rate
        FROM lines_fact f JOIN dim_route USING (route_id) LEFT JOIN reviews v ON f.booking_id = v.booking_id GROUP BY 1""",
    ),
)
def ri04(spark, sf):
    return insights.difficulty_profile(tpch.line_star(spark, sf, region=False))


@query(
    "ri05_top_discounting_guides",
    over(
        "lines_fact dim_guide",
        f"""SELECT guide_id, full_name, discount_tendency_pct, count(*) AS bookings, {CONFIRMED} AS revenue,
        {div("count(*) FILTER (WHERE discount_applied)", "count(*)")} AS discounted_share
        FROM lines_fact JOIN dim_guide USING (guide_id) GROUP BY 1, 2, 3 ORDER BY discount_tendency_pct DESC, guide_id LIMIT 5""",
    ),
)
def ri05(spark, sf):
    return insights.top_discounting_guides(tpch.line_star(spark, sf, region=False))


@query(
    "ri06_unique_and_repeat_customers",
    f"""SELECT count(*) AS unique_customers, count(*) FILTER (WHERE n > 1) AS repeat_any_status, count(*) FILTER (WHERE t > 1) AS repeat_trips,
    {rate("count(*) FILTER (WHERE n > 1)", "count(*)")} AS repeat_rate_any_status, {rate("count(*) FILTER (WHERE t > 1)", "count(*)")} AS repeat_rate_trips
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus IN ('F','O')) AS t FROM orders GROUP BY o_custkey)""",
)
def ri06(spark, sf):
    return insights.repeat_customers(tpch.order_star(spark, sf, region=False))


@query(
    "ri07_channel_returns",
    over(
        "marketing dim_channel",
        f"""SELECT channel_name, CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(revenue) AS DOUBLE) AS revenue, {rate("sum(revenue)", "sum(spend)", 1)} AS roas
        FROM marketing JOIN dim_channel USING (channel_id) GROUP BY 1""",
    ),
)
def ri07(spark, sf):
    return insights.channel_returns(tpch.order_star(spark, sf, region=False))


@query(
    "ri08_weather_share_of_cancellations",
    over(
        "lines_fact weather",
        f"""SELECT count(*) AS cancellations, count(*) FILTER (WHERE storm_warning OR rain_mm > 15) AS weather_flagged,
        {rate("count(*) FILTER (WHERE storm_warning OR rain_mm > 15)", "count(*)")} AS weather_flagged_share
        FROM lines_fact f LEFT JOIN weather w ON f.region_id = w.region_id AND f.tour_date = w.d WHERE status = 'cancelled'""",
    ),
)
def ri08(spark, sf):
    return insights.weather_share_of_cancellations(tpch.line_star(spark, sf))


@query(
    "ri09_payment_health",
    over(
        "payments",
        f"""SELECT status, count(*) AS payments, CAST(sum(amount) AS DOUBLE) AS amount,
        (SELECT {rate("count(*) FILTER (WHERE status = 'paid')", "count(*) FILTER (WHERE status IN ('paid','failed'))")} FROM payments) AS success_rate,
        (SELECT {rate("count(*) FILTER (WHERE status = 'refunded')", "count(*) FILTER (WHERE status = 'paid')")} FROM payments) AS refund_rate
        FROM payments GROUP BY 1""",
    ),
)
def ri09(spark, sf):
    return insights.payment_health(tpch.order_star(spark, sf, region=False))


@query(
    "ri10_discount_cost",
    over(
        "lines_fact",
        f"""SELECT {rate("count(*) FILTER (WHERE discount_applied)", "count(*)")} AS discounted_share, CAST(sum(list_price - total_price) AS DOUBLE) AS discount_given,
        {rate("sum(list_price - total_price)", "sum(list_price)")} AS share_of_gross FROM lines_fact WHERE status IN ('confirmed','amended')""",
    ),
)
def ri10(spark, sf):
    return insights.discount_cost(tpch.line_star(spark, sf, region=False))


# ------------------------------------------------------------------ roll-ups


@query(
    "x1_attributed_conversions",
    over(
        "orders_fact",
        """SELECT event_type AS channel, date_trunc('month', created_date)::DATE AS month, count(*) AS conversions, CAST(sum(total_price) AS DOUBLE) AS revenue
        FROM orders_fact LEFT JOIN events ON event_id = booking_id WHERE status IN ('confirmed','amended') GROUP BY 1, 2""",
    ),
)
def x1(spark, sf):
    bookings = tpch.order_bookings(spark, sf, region=False).withColumn("created_date", dates.key_date("created_date_id"))
    attribution = table(spark, sf, "events").select(F.col("event_id").alias("booking_id"), F.col("event_type").alias("channel"))
    return insights.attributed_conversions(bookings, attribution)


@query(
    "x2_tour_statuses",
    over(
        "lines_fact",
        """SELECT o_orderkey AS tour_id, CAST(coalesce(sum(party_size), 0) AS BIGINT) AS booked, CASE WHEN o_orderstatus = 'P' THEN 'cancelled'
        WHEN coalesce(sum(party_size), 0) >= 8 THEN 'full' ELSE 'open' END AS status FROM orders LEFT JOIN lines_fact ON booking_id = o_orderkey GROUP BY o_orderkey, o_orderstatus""",
    ),
)
def x2(spark, sf):
    tours = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tour_id"), F.lit(8).alias("max_group_size"), (F.col("o_orderstatus") == "P").alias("ops_cancelled")
    )
    bookings = tpch.line_bookings(spark, sf, region=False).withColumnRenamed("booking_id", "tour_id")
    return insights.tour_statuses(tours, bookings)


@query(
    "x3_active_guides_on_date",
    over(
        "span",
        f""", {MEMBERS_SQL}, need AS (SELECT DISTINCT CAST(n_regionkey AS BIGINT) AS region_id, ts::DATE AS day FROM events, nation
          UNION SELECT DISTINCT CAST(p_size % 7 AS BIGINT), l_shipdate::DATE FROM lineitem JOIN part ON l_partkey = p_partkey),
        own AS (SELECT n.region_id, n.day, count(m.joined) AS a FROM need n LEFT JOIN members m ON m.region_id = n.region_id
          AND m.joined <= n.day AND coalesce(m.left_on, DATE '9999-01-01') >= n.day GROUP BY 1, 2),
        anyone AS (SELECT n.day, count(m.joined) AS a FROM (SELECT DISTINCT day FROM need) n LEFT JOIN members m
          ON n.day BETWEEN m.joined AND coalesce(m.left_on, DATE '9999-01-01') GROUP BY 1)
        SELECT region_id, day, own.a AS active_in_group, own.a = 0 AS used_fallback, if(own.a = 0, anyone.a, own.a) AS available FROM own JOIN anyone USING (day)""",
    ),
)
def x3(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("day"))
    parts = table(spark, sf, "part").select("p_partkey", F.pmod("p_size", F.lit(7)).cast("bigint").alias("region_id"))
    shipped = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("region_id", "day").distinct()
    event_days = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    # Each day is wanted in every region: as many rows as the calendar has days, times the regions of the table.
    regions = table(spark, sf, "nation").agg(F.collect_set(F.col("n_regionkey").cast("bigint"))).scalar()
    need = shipped.unionByName(event_days.select(F.explode(regions).alias("region_id"), "day")).distinct()
    return intervals.active_on(need, "day", "region_id", members(spark, sf), "joined", "left_on")


@query(
    "m33_storm_and_bad_weather_days",
    over(
        "weather dim_region",
        """SELECT name AS region, count(*) FILTER (WHERE storm_warning) AS storm_days, count(*) FILTER (WHERE storm_warning OR rain_mm > 15) AS bad_weather_days
        FROM weather JOIN dim_region USING (region_id) GROUP BY 1""",
    ),
)
def m33(spark, sf):
    return insights.storm_days(tpch.order_star(spark, sf, region=False))
