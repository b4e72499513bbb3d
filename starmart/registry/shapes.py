"""Relational shapes: projections, predicates, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.numbers import count_rows, money, rate, ratio, sum_if
from starmart.operators import dedupe, drilldown, intervals, lookup, median, ranking, series
from starmart.plans import insights, measures, quality, reports, validation
from starmart.registry import query
from starmart.registry.sql import MONEY_LIST, MONEY_PRICE, div, over, rnd, ymd
from starmart.registry.sql import rate as sql_rate
from starmart.schemas import Contract, Field, between
from starmart.sources import tpch
from starmart.sources.tpch import table

NET = f"({MONEY_LIST} * (1 - CAST(l_discount AS DECIMAL(4,2))))"


def _net():
    return money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))


# ------------------------------------------------------------------ projections and predicates


@query("p01_fixed_column_order", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def p01(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    "p02_rename_and_alias",
    "SELECT c_custkey AS customer_id, c_name AS contact_name, c_mktsegment AS segment FROM customer",
)
def p02(spark, sf):
    names = {"c_custkey": "customer_id", "c_name": "contact_name", "c_mktsegment": "segment"}
    return table(spark, sf, "customer").select(*names).withColumnsRenamed(names)


@query("p03_enum_equality", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def p03(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").agg(count_rows().alias("n"))


@query(
    "p04_in_list",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F','O') GROUP BY 1",
)
def p04(spark, sf):
    kept = table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    return kept.groupBy("o_orderstatus").agg(count_rows().alias("n"))


@query(
    "p05_not_equal",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1",
)
def p05(spark, sf):
    kept = table(spark, sf, "lineitem").where(F.col("l_returnflag") != "R")
    return kept.groupBy("l_returnflag").agg(count_rows().alias("n"))


@query(
    "p06_between_inclusive",
    "SELECT count(*) AS n, min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem WHERE l_discount BETWEEN 0.02 AND 0.05",
)
def p06(spark, sf):
    kept = table(spark, sf, "lineitem").where(F.col("l_discount").between(0.02, 0.05))
    return kept.agg(count_rows().alias("n"), F.min("l_discount").alias("lo"), F.max("l_discount").alias("hi"))


@query(
    "p07_is_not_null",
    "SELECT count(*) AS reviewed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL",
)
def p07(spark, sf):
    kept = tpch.reviews(spark, sf).where(F.col("overall_rating").isNotNull())
    return kept.agg(count_rows().alias("reviewed"))


@query(
    "p08_disjunction",
    over("weather", "SELECT region_id, count(*) AS bad_days FROM weather WHERE storm_warning OR rain_mm > 15 GROUP BY 1"),
)
def p08(spark, sf):
    bad = tpch.weather(spark, sf).where(reports.bad_weather())
    return bad.groupBy("region_id").agg(count_rows().alias("bad_days"))


@query("p09_boolean_column", over("dim_guide", "SELECT guide_id, full_name FROM dim_guide WHERE active"))
def p09(spark, sf):
    return tpch.dim_guide(spark, sf).where("active").select("guide_id", "full_name")


@query(
    "p10_having_volume_floor",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10",
)
def p10(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(count_rows().alias("n"))
    return per_customer.where("n > 10")


@query(
    "p11_having_scalar_subquery",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders GROUP BY 1
    HAVING strftime(o_orderdate, '%Y-%m') <= (SELECT strftime(max(l_shipdate) - INTERVAL 13 MONTH, '%Y-%m') FROM lineitem)""",
)
def p11(spark, sf):
    last = table(spark, sf, "lineitem").agg(F.max(F.to_date("l_shipdate")).alias("d"))
    cutoff = last.select(dates.year_month(F.add_months("d", -13))).scalar()
    months = table(spark, sf, "orders").groupBy(dates.year_month("o_orderdate").alias("ym")).agg(count_rows().alias("n"))
    return months.where(F.col("ym") <= cutoff)


@query(
    "p12_filter_on_rank",
    f"""SELECT p_brand, p_partkey, p_retailprice FROM (
      SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS r FROM part) WHERE r <= 3""",
)
def p12(spark, sf):
    top = ranking.top_ranked(table(spark, sf, "part"), ["p_brand"], [F.desc("p_retailprice")], 3, "r")
    return top.select("p_brand", "p_partkey", "p_retailprice")


@query(
    "p13_bound_parameters",
    """SELECT l_returnflag, count(*) AS n FROM lineitem
    WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01' AND l_discount >= 0.03 GROUP BY 1""",
)
def p13(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("starmart_lines")
    return reports.sql_report(
        spark,
        """SELECT l_returnflag, count(*) AS n FROM starmart_lines
        WHERE l_shipdate >= make_date(:year, 1, 1) AND l_shipdate < make_date(:year + 1, 1, 1)
          AND l_discount >= :min_discount GROUP BY l_returnflag""",
        year=1997,
        min_discount=0.03,
    )


@query("p14_distinct_projection", f"SELECT DISTINCT l_suppkey AS guide_id, {ymd('l_shipdate')} AS date_id FROM lineitem")
def p14(spark, sf):
    return tpch.line_bookings(spark, sf, region=False).select("guide_id", F.col("tour_date_id").alias("date_id")).distinct()


@query(
    "p15_slicer",
    over(
        "orders_fact dim_region",
        """SELECT name AS region, count(*) AS total_bookings FROM orders_fact JOIN dim_region USING (region_id)
        WHERE name IN ('ASIA','EUROPE') AND year(tour_date) = 1998 AND season = 'winter' GROUP BY 1""",
    ),
)
def p15(spark, sf):
    context = {"region": ["ASIA", "EUROPE"], "year": 1998, "season": "winter"}
    return measures.measure(tpch.order_star(spark, sf), "total_bookings", ["region"], context)


@query(
    "p16_lifted_filter",
    over(
        "orders_fact",
        f"""SELECT status, count(*) AS total_bookings,
        {div("count(*)", "(SELECT count(*) FROM orders_fact WHERE year(tour_date) = 1998)")} AS share_of_all_statuses
        FROM orders_fact WHERE year(tour_date) = 1998 AND status IN ('confirmed','amended') GROUP BY 1""",
    ),
)
def p16(spark, sf):
    star = tpch.order_star(spark, sf, region=False)
    context = {"year": 1998, "status": ["confirmed", "amended"]}
    everything = measures.measure(star, "total_bookings", [], measures.lifted(context, "status")).scalar()
    shown = measures.measure(star, "total_bookings", ["status"], context)
    return shown.withColumn("share_of_all_statuses", ratio(F.col("total_bookings"), everything))


# ------------------------------------------------------------------ joins


@query(
    "j01_star_join",
    """SELECT r_name, n_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def j01(spark, sf):
    # Orders per customer first, so that a hot customer crosses the joins as one row.
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(count_rows().alias("n"))
    return (
        per_customer.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name")
        .agg(F.sum("n").alias("n"))
    )


@query(
    "j02_role_playing_dates",
    over(
        "orders_fact",
        """SELECT year(created_date) AS created_year, year(tour_date) AS tour_year, count(*) AS n
        FROM orders_fact GROUP BY 1, 2""",
    ),
)
def j02(spark, sf):
    star = tpch.order_star(spark, sf, region=False)
    # Wider than the tour span: creation precedes the first tour.
    facts = star["FactBookings"].groupBy("tour_date_id", "created_date_id").agg(count_rows().alias("n"))
    days = star["DimDate"].select("date_id", "year")
    tour = days.withColumnsRenamed({"date_id": "tour_date_id", "year": "tour_year"})
    created = days.withColumnsRenamed({"date_id": "created_date_id", "year": "created_year"})
    both = facts.join(tour, "tour_date_id").join(created, "created_date_id")
    return both.groupBy("created_year", "tour_year").agg(F.sum("n").alias("n"))


@query(
    "j02_measure_by_created_date",
    over(
        "orders_fact",
        "SELECT month(created_date) AS month, count(*) AS total_bookings FROM orders_fact GROUP BY 1",
    ),
)
def j02_created(spark, sf):
    star = tpch.order_star(spark, sf, region=False)
    return measures.measure(star, "total_bookings", ["month"], date_role="created")


@query(
    "j03_left_outer_nullable_key",
    """SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def j03(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return lookup.lookup(docs, "doc_id", table(spark, sf, "labels"), "doc_id", {"quality": "quality"})


@query(
    "j04_left_outer_subset_fact",
    over(
        "reviews",
        f"""SELECT o_orderpriority, count(*) AS bookings, count(comment_length) AS reviews,
        {sql_rate("sum(overall_rating)", "count(overall_rating)", 2)} AS avg_rating
        FROM orders LEFT JOIN reviews ON o_orderkey = booking_id GROUP BY 1""",
    ),
)
def j04(spark, sf):
    reviewed = tpch.reviews(spark, sf).select("booking_id", "overall_rating", "comment_length")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    joined = orders.join(reviewed, F.col("o_orderkey") == F.col("booking_id"), "left")
    return joined.groupBy("o_orderpriority").agg(
        count_rows().alias("bookings"),
        F.count("comment_length").alias("reviews"),
        rate(F.sum("overall_rating"), F.count("overall_rating"), 2).alias("avg_rating"),
    )


@query(
    "j05_right_outer_keeps_channels",
    over(
        "marketing dim_channel",
        """SELECT channel_name, coalesce(CAST(sum(conversions) AS BIGINT), 0) AS conversions
        FROM marketing RIGHT JOIN dim_channel USING (channel_id) GROUP BY 1""",
    ),
)
def j05(spark, sf):
    star = tpch.order_star(spark, sf, region=False)
    sums = star["FactMarketing"].groupBy("channel_id").agg(F.sum("conversions").alias("conversions"))
    return sums.join(star["DimMarketingChannel"], "channel_id", "right").select(
        "channel_name", F.coalesce("conversions", F.lit(0)).alias("conversions")
    )


@query(
    "j06_composite_date_region",
    over(
        "lines_fact weather",
        """SELECT f.region_id, count(*) AS cancelled, count(*) FILTER (WHERE storm_warning) AS in_storm
        FROM lines_fact f JOIN weather w ON f.region_id = w.region_id AND f.tour_date = w.d
        WHERE status = 'cancelled' GROUP BY 1""",
    ),
)
def j06(spark, sf):
    per_day = (
        tpch.line_bookings(spark, sf)
        .where("status = 'cancelled'")
        .groupBy("region_id", F.col("tour_date_id").alias("date_id"))
        .agg(count_rows().alias("n"))
    )
    joined = per_day.join(tpch.weather(spark, sf), ["region_id", "date_id"])
    return joined.groupBy("region_id").agg(
        F.sum("n").alias("cancelled"), F.sum(F.when(F.col("storm_warning"), F.col("n")).otherwise(0)).alias("in_storm")
    )


@query(
    "j07_range_condition_in_on",
    f"""SELECT s_suppkey AS guide_id, count(l_orderkey) AS bookings FROM supplier LEFT JOIN lineitem
    ON s_suppkey = l_suppkey AND l_shipdate BETWEEN DATE '2001-10-01' AND DATE '2001-12-31' GROUP BY 1""",
)
def j07(spark, sf):
    in_range = F.col("tour_date_id").between(20011001, 20011231)
    booked = tpch.line_bookings(spark, sf, region=False).where(in_range).groupBy("guide_id").agg(count_rows().alias("n"))
    guides = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("guide_id"))
    return guides.join(booked, "guide_id", "left").select("guide_id", F.coalesce("n", F.lit(0)).alias("bookings"))


@query(
    "j08_anti_orphans",
    "SELECT event_id FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents)",
)
def j08(spark, sf):
    return lookup.orphans(
        table(spark, sf, "events").select("event_id"), "event_id", table(spark, sf, "documents"), "doc_id"
    )


@query(
    "j08_orphan_flag",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE d.doc_id IS NULL) AS orphans
    FROM events e LEFT JOIN documents d ON e.event_id = d.doc_id""",
)
def j08_flag(spark, sf):
    events = table(spark, sf, "events").select("event_id")
    flagged = lookup.flag_missing(events, "event_id", table(spark, sf, "documents"), "doc_id", "orphan")
    return flagged.agg(count_rows().alias("rows"), F.count_if("orphan").alias("orphans"))


@query(
    "j09_semi_resolved",
    "SELECT event_id, user_id FROM events WHERE event_id IN (SELECT doc_id FROM labels)",
)
def j09(spark, sf):
    return lookup.resolved(
        table(spark, sf, "events").select("event_id", "user_id"), "event_id", table(spark, sf, "labels"), "doc_id"
    )


@query(
    "j10_natural_to_surrogate_key",
    """SELECT n_name, r_regionkey AS region_id FROM nation JOIN region
    ON CASE n_regionkey WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' WHEN 3 THEN 'EUROPE' ELSE 'MIDDLE EAST' END = r_name""",
)
def j10(spark, sf):
    regions = table(spark, sf, "region")
    # The nation carries the region's name, as a cleaned source would; the name is resolved to the key.
    named = lookup.lookup(table(spark, sf, "nation"), "n_regionkey", regions, "r_regionkey", {"r_name": "region"})
    return lookup.lookup(named, "region", regions, "r_name", {"r_regionkey": "region_id"}).select("n_name", "region_id")


@query(
    "j11_wide_left_join_chain",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE AS tour_date,
    o_orderstatus AS status, l_linestatus AS status_line, p_type, r_name AS region, c_mktsegment
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON o_custkey = c_custkey""",
)
def j11(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("tour_date"),
        F.col("l_linestatus").alias("status_line"),
    )
    # One lookup at a time: Spark knows the size of each table, not that of a join of tables.
    df = lookup.lookup(lines, "l_partkey", table(spark, sf, "part"), "p_partkey", {"p_type": "p_type"})
    df = lookup.lookup(df, "l_suppkey", table(spark, sf, "supplier"), "s_suppkey", {"s_nationkey": "_nation"})
    df = lookup.lookup(df, "_nation", table(spark, sf, "nation"), "n_nationkey", {"n_regionkey": "_region"})
    df = lookup.lookup(df, "_region", table(spark, sf, "region"), "r_regionkey", {"r_name": "region"})
    take = {"o_orderstatus": "status", "o_custkey": "_customer"}
    df = lookup.lookup(df, "l_orderkey", table(spark, sf, "orders"), "o_orderkey", take)
    df = lookup.lookup(df, "_customer", table(spark, sf, "customer"), "c_custkey", {"c_mktsegment": "c_mktsegment"})
    return df.drop("_nation", "_region", "_customer")


@query(
    "j12_key_propagation",
    over(
        "reviews",
        """SELECT r.booking_id, o_custkey AS customer_id, overall_rating::INTEGER AS overall_rating
        FROM reviews r LEFT JOIN orders ON r.booking_id = o_orderkey""",
    ),
)
def j12(spark, sf):
    keys = tpch.order_bookings(spark, sf, region=False).select("booking_id", "customer_id")
    return tpch.reviews(spark, sf).join(keys, "booking_id", "left").select("booking_id", "customer_id", "overall_rating")


@query(
    "j13_join_against_view",
    over(
        "lines_fact weather",
        """, flagged AS (SELECT booking_id, line, f.tour_date, CASE WHEN storm_warning OR rain_mm > 15 THEN 1 ELSE 0 END AS flag
           FROM lines_fact f JOIN weather w ON f.region_id = w.region_id AND f.tour_date = w.d WHERE status = 'cancelled')
        SELECT year(tour_date) AS year, count(*) AS cancellations, CAST(sum(flag) AS BIGINT) AS flagged FROM flagged GROUP BY 1""",
    ),
)
def j13(spark, sf):
    view = reports.weather_flagged_cancellations(tpch.line_star(spark, sf))
    return view.groupBy(F.year("tour_date").alias("year")).agg(
        count_rows().alias("cancellations"), F.sum("weather_flagged").alias("flagged")
    )


@query(
    "j14_first_to_later_trips",
    """WITH seen AS (SELECT o_custkey AS customer_id, list_sort(list(DISTINCT o_orderdate::DATE)) AS days FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL)
    SELECT customer_id, CAST(ifnull(days[2] - days[1] <= 182, false) AS INTEGER) AS within_6m, CAST(ifnull(days[2] - days[1] <= 365, false) AS INTEGER) AS within_12m FROM seen""",
)
def j14(spark, sf):
    trips = reports.first_and_second_trip(tpch.order_star(spark, sf, region=False))
    gap = F.datediff("second_day", "first_day")
    return trips.select(
        "customer_id",
        F.when(gap <= reports.SIX_MONTHS, 1).otherwise(0).alias("within_6m"),
        F.when(gap <= reports.TWELVE_MONTHS, 1).otherwise(0).alias("within_12m"),
    )


@query(
    "j15_scalar_key_lookup",
    over("dim_route dim_region", "SELECT route_id, r.name AS region_name FROM dim_route LEFT JOIN dim_region r USING (region_id)"),
)
def j15(spark, sf):
    routes = tpch.dim_route(spark, sf).select("route_id", "region_id")
    named = lookup.lookup(routes, "region_id", tpch.dim_region(spark, sf), "region_id", {"name": "region_name"})
    return named.drop("region_id")


@query(
    "j16_correlated_existence",
    over(
        "lines_fact weather",
        """SELECT count(*) AS flagged FROM lines_fact f WHERE status = 'cancelled' AND EXISTS (
        SELECT 1 FROM weather w WHERE w.region_id = f.region_id AND w.d = f.tour_date AND (storm_warning OR rain_mm > 15))""",
    ),
)
def j16(spark, sf):
    bad = tpch.weather(spark, sf).where(reports.bad_weather()).select("region_id", F.col("date_id").alias("tour_date_id"))
    cancelled = tpch.line_bookings(spark, sf).where("status = 'cancelled'")
    per_day = cancelled.groupBy("region_id", "tour_date_id").agg(count_rows().alias("n"))
    return per_day.join(bad, ["region_id", "tour_date_id"], "left_semi").agg(F.sum("n").alias("flagged"))


@query(
    "j17_share_of_grand_total",
    f"""SELECT o_orderpriority, CAST(sum({MONEY_PRICE}) AS DOUBLE) AS revenue,
    {div(f"sum({MONEY_PRICE})", f"(SELECT sum({MONEY_PRICE}) FROM orders)")} AS share FROM orders GROUP BY 1""",
)
def j17(spark, sf):
    per_channel = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.sum(money("o_totalprice")).alias("revenue"))
    return series.share_of_total(per_channel, "revenue", "share")


MEMBERS_SQL = """members AS (SELECT CAST(n_regionkey AS BIGINT) AS region_id,
    min(l_shipdate)::DATE AS joined, CASE WHEN s_acctbal < 5000 THEN max(l_shipdate)::DATE END AS left_on
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey
    GROUP BY s_suppkey, s_acctbal, n_regionkey)"""


def members(spark, sf) -> DataFrame:
    """Guides with the days of their first and last tour; the well paid ones never left."""
    worked = tpch.line_bookings(spark, sf, region=False).groupBy("guide_id").agg(
        F.min("tour_date_id").alias("first"), F.max("tour_date_id").alias("last")
    )
    rich = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("guide_id"), "s_acctbal")
    return (
        tpch.dim_guide(spark, sf)
        .join(worked, "guide_id")
        .join(rich, "guide_id")
        .select(
            "guide_id",
            F.col("primary_region_id").alias("region_id"),
            dates.key_date("first").alias("joined"),
            F.when(F.col("s_acctbal") < 5000, dates.key_date("last")).alias("left_on"),
        )
    )


@query(
    "j18_validity_interval_join",
    over(
        "orders_fact",
        f""", {MEMBERS_SQL}, need AS (SELECT DISTINCT region_id, tour_date AS day FROM orders_fact),
        own AS (SELECT n.region_id, n.day, count(m.joined) AS a FROM need n LEFT JOIN members m ON m.region_id = n.region_id
          AND m.joined <= n.day AND (m.left_on IS NULL OR m.left_on >= n.day) GROUP BY 1, 2),
        anyone AS (SELECT n.day, count(m.joined) AS a FROM (SELECT DISTINCT day FROM need) n LEFT JOIN members m
          ON m.joined <= n.day AND (m.left_on IS NULL OR m.left_on >= n.day) GROUP BY 1)
        SELECT region_id, day, own.a AS active_in_group, own.a = 0 AS used_fallback,
        CASE WHEN own.a = 0 THEN anyone.a ELSE own.a END AS available FROM own JOIN anyone USING (day)""",
    ),
)
def j18(spark, sf):
    need = tpch.order_bookings(spark, sf).select("region_id", dates.key_date("tour_date_id").alias("day")).distinct()
    return intervals.active_on(need, "day", "region_id", members(spark, sf), "joined", "left_on")


# ------------------------------------------------------------------ aggregates


@query("a01_count_rows", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def a01(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(count_rows().alias("n"))


@query(
    "a02_count_skips_null",
    "SELECT lang, count(*) AS docs, count(quality) AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1",
)
def a02(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    labelled = lookup.lookup(docs, "doc_id", table(spark, sf, "labels"), "doc_id", {"quality": "quality"})
    return labelled.groupBy("lang").agg(count_rows().alias("docs"), F.count("quality").alias("labelled"))


@query(
    "a03_sum_exact_money",
    f"SELECT l_suppkey, CAST(sum({NET}) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1",
)
def a03(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(_net()).alias("revenue"))


@query(
    "a04_conditional_sum",
    f"""SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {MONEY_PRICE} ELSE 0 END) AS DOUBLE) AS revenue,
    CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS cancellations FROM orders GROUP BY 1""",
)
def a04(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        sum_if(F.col("o_orderstatus") == "F", money("o_totalprice")).alias("revenue"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("cancellations"),
    )


@query(
    "a05_conditional_average",
    f"""SELECT o_orderpriority, {sql_rate(f"sum({MONEY_PRICE}) FILTER (WHERE o_orderstatus = 'F')",
    "count(*) FILTER (WHERE o_orderstatus = 'F')", 2)} AS avg_value FROM orders GROUP BY 1""",
)
def a05(spark, sf):
    price = F.when(F.col("o_orderstatus") == "F", money("o_totalprice"))
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        rate(F.sum(price), F.count(price), 2).alias("avg_value")
    )


@query(
    "a06_filter_clause",
    "SELECT event_type, count(*) FILTER (WHERE value > 50) AS big FROM events GROUP BY 1",
)
def a06(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("big"))


@query(
    "a07_rate_four_places",
    f"""SELECT l_suppkey, {sql_rate("count(*) FILTER (WHERE l_returnflag = 'R')", "count(*)")} AS cancellation_rate
    FROM lineitem GROUP BY 1""",
)
def a07(spark, sf):
    cancelled = F.count_if(F.col("l_returnflag") == "R")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(rate(cancelled, count_rows()).alias("cancellation_rate"))


@query(
    "a08_rate_null_without_rows",
    f"""SELECT d.doc_id, {sql_rate("count(*) FILTER (WHERE l.toxic = 1)", "count(l.doc_id)")} AS toxic_rate
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def a08(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    joined = lookup.lookup(docs, "doc_id", table(spark, sf, "labels"), "doc_id", {"toxic": "toxic"})
    return joined.groupBy("doc_id").agg(rate(F.count_if(F.col("toxic") == 1), F.count("toxic")).alias("toxic_rate"))


@query(
    "a09_null_skipping_average",
    over(
        "reviews",
        f"""SELECT comment_length % 7 AS bucket, {sql_rate("sum(overall_rating)", "count(overall_rating)", 2)} AS avg_overall,
        {sql_rate("sum(guide_rating)", "count(guide_rating)", 2)} AS avg_guide FROM reviews GROUP BY 1""",
    ),
)
def a09(spark, sf):
    bucket = F.pmod("comment_length", F.lit(7)).cast("bigint").alias("bucket")
    return tpch.reviews(spark, sf).groupBy(bucket).agg(
        rate(F.sum("overall_rating"), F.count("overall_rating"), 2).alias("avg_overall"),
        rate(F.sum("guide_rating"), F.count("guide_rating"), 2).alias("avg_guide"),
    )


@query(
    "a10_min_max_dates",
    "SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1",
)
def a10(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@query(
    "a11_any_row_qualifies",
    "SELECT l_suppkey, max(CASE WHEN l_discount >= 0.1 AND l_quantity = 50 THEN 1 ELSE 0 END) AS any_big_deal FROM lineitem GROUP BY 1",
)
def a11(spark, sf):
    hit = (F.col("l_discount") >= 0.1) & (F.col("l_quantity") == 50)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.max(F.when(hit, 1).otherwise(0)).alias("any_big_deal"))


@query(
    "a12_sum_or_zero",
    """SELECT d.doc_id, coalesce(sum(e.value), 0) AS spent FROM documents d
    LEFT JOIN events e ON e.event_id = d.doc_id AND e.event_type = 'purchase' GROUP BY 1""",
)
def a12(spark, sf):
    bought = table(spark, sf, "events").where("event_type = 'purchase'").select("event_id", "value")
    docs = table(spark, sf, "documents").select("doc_id")
    joined = docs.join(bought, F.col("doc_id") == F.col("event_id"), "left")
    return joined.groupBy("doc_id").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("spent"))


@query(
    "a13_guarded_ratio_of_sums",
    over(
        "marketing",
        f"""SELECT channel_id, CASE WHEN sum(spend) > 0 THEN {sql_rate("sum(revenue)", "sum(spend)", 2)} END AS roas,
        CASE WHEN sum(conversions) > 0 THEN {sql_rate("sum(spend)", "sum(conversions)", 2)} ELSE 0 END AS cost_per_booking
        FROM marketing GROUP BY 1""",
    ),
)
def a13(spark, sf):
    sums = tpch.marketing(spark, sf).groupBy("channel_id").agg(
        *[F.sum(c).alias(c) for c in ("spend", "revenue", "conversions")]
    )
    return sums.select(
        "channel_id",
        rate(F.when(F.col("spend") > 0, F.col("revenue")), F.col("spend"), 2).alias("roas"),
        F.coalesce(rate(F.col("spend"), F.col("conversions"), 2), F.lit(0.0)).alias("cost_per_booking"),
    )


@query(
    "a14_flag_from_count",
    "SELECT l_orderkey, CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS is_repeat FROM lineitem GROUP BY 1",
)
def a14(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.when(count_rows() > 1, 1).otherwise(0).alias("is_repeat"))


@query(
    "a15_exact_distinct_counts",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS routes, count(DISTINCT l_suppkey) AS guides,
    count(DISTINCT l_shipdate) AS days FROM lineitem GROUP BY 1""",
)
def a15(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("routes"),
        F.countDistinct("l_suppkey").alias("guides"),
        F.countDistinct("l_shipdate").alias("days"),
    )


@query(
    "a16_distinct_then_sum",
    over(
        "dim_guide",
        """SELECT CAST(sum(day_rate_gbp) AS DOUBLE) AS guide_cost FROM
        (SELECT DISTINCT l_suppkey AS guide_id, l_shipdate FROM lineitem WHERE l_returnflag <> 'R') JOIN dim_guide USING (guide_id)""",
    ),
)
def a16(spark, sf):
    return measures.measure(tpch.line_star(spark, sf, region=False), "guide_cost")


@query(
    "a17_row_expression",
    f"""SELECT l_returnflag, CAST(sum({MONEY_LIST} - CAST({NET} AS DECIMAL(18,2))) AS DOUBLE) AS discount_given,
    {div("sum(CAST(l_quantity AS BIGINT))", "count(*)")} / 3 AS avg_thirds FROM lineitem GROUP BY 1""",
)
def a17(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag").agg(
        F.sum(money("l_extendedprice") - money(_net())).alias("discount_given"),
        (ratio(F.sum(F.col("l_quantity").cast("bigint")), count_rows()) / 3).alias("avg_thirds"),
    )


@query(
    "a18_latest_known_value",
    """SELECT user_id, arg_max(value, struct_pack(t := ts, i := event_id)) FILTER (WHERE event_type = 'purchase') AS last_purchase
    FROM events GROUP BY 1""",
)
def a18(spark, sf):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    latest = ranking.latest_known("bought", F.struct("ts", "event_id"))
    return table(spark, sf, "events").withColumn("bought", bought).groupBy("user_id").agg(latest.alias("last_purchase"))


@query("a19_group_median", "SELECT p_type, median(p_retailprice) AS median_price FROM part GROUP BY 1")
def a19(spark, sf):
    return median.group_median(table(spark, sf, "part"), ["p_type"], "p_retailprice", "median_price")


@query(
    "a19_median_of_a_hot_group",
    "SELECT l_returnflag, median(l_extendedprice) AS median_price FROM lineitem GROUP BY 1",
)
def a19_hot(spark, sf):
    lines = table(spark, sf, "lineitem")
    return median.group_median(lines, ["l_returnflag"], "l_extendedprice", "median_price")


@query(
    "a20_two_level_aggregate",
    over(
        "holidays",
        f"""SELECT h.d IS NOT NULL AS is_bank_holiday, {rnd(div("sum(rev)", "count(*)"), 2)} AS avg_revenue FROM
        (SELECT o_orderdate::DATE AS day, sum({MONEY_PRICE}) AS rev FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) x
        LEFT JOIN holidays h ON h.d = x.day GROUP BY 1""",
    ),
)
def a20(spark, sf):
    star = tpch.order_star(spark, sf, region=False)
    flags = star["DimDate"].select(F.col("date_id").alias("tour_date_id"), "is_bank_holiday")
    daily = insights.daily_revenue(star).join(flags, "tour_date_id")
    return daily.groupBy("is_bank_holiday").agg(rate(F.sum("revenue"), count_rows(), 2).alias("avg_revenue"))


@query(
    "a21_covariance_and_correlation",
    over(
        "lines_fact dim_guide",
        """SELECT count(*) AS guides, round(covar_samp(discount_tendency_pct, share), 9) AS covariance,
        round(corr(discount_tendency_pct, share), 9) AS correlation FROM (
        SELECT guide_id, count(*) FILTER (WHERE discount_applied) / count(*) AS share FROM lines_fact GROUP BY 1 HAVING count(*) > 50)
        JOIN dim_guide USING (guide_id)""",
    ),
)
def a21(spark, sf):
    return insights.discount_correlation(tpch.line_star(spark, sf, region=False))


@query(
    "a22_dependent_group_keys",
    """SELECT s_suppkey, s_name, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def a22(spark, sf):
    per_guide = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(count_rows().alias("n"))
    joined = per_guide.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select("s_suppkey", "s_name", "n_name", "n")


@query(
    "a23_group_by_alias",
    """SELECT CASE WHEN month(o_orderdate) IN (11,12,1,2,3) THEN 'Winter season' ELSE 'Summer season' END AS season_bucket,
    count(*) AS n FROM orders GROUP BY season_bucket""",
)
def a23(spark, sf):
    bucket = dates.trading_season(F.month("o_orderdate"))
    return table(spark, sf, "orders").groupBy(bucket.alias("season_bucket")).agg(count_rows().alias("n"))


LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    "a24_dedupe_keep_first",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate::DATE AS ship_date FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1""",
)
def a24(spark, sf):
    first = dedupe.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER.split(", "))
    return first.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("ship_date")
    )


@query(
    "a24_dedupe_removed_count",
    """SELECT count(*) AS rows_in, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_out,
    count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed FROM lineitem""",
)
def a24_removed(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return dedupe.removed_count(dedupe.keep_first(lines, ["l_orderkey", "l_linenumber"], "l_shipdate"))


@query(
    "a25_completeness",
    over(
        "reviews",
        f"""SELECT {rnd("(count(overall_rating) + count(guide_rating) + count(route_rating) + count(safety_rating) + "
                       "count(value_rating))::DOUBLE / (count(*) * 5)", 4)} AS completeness FROM reviews""",
    ),
)
def a25(spark, sf):
    ratings = ["overall_rating", "guide_rating", "route_rating", "safety_rating", "value_rating"]
    return tpch.reviews(spark, sf).agg(dedupe.completeness(ratings).alias("completeness"))


@query(
    "a26_pivot_stage_counts",
    """SELECT 'Lines' AS "table", CAST(count(*) AS DOUBLE) AS raw, CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) AS cleaned
    FROM lineitem UNION ALL SELECT 'Orders', CAST(count(*) AS DOUBLE), CAST(count(DISTINCT o_orderkey) AS DOUBLE) FROM orders""",
)
def a26(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    firsts = {
        "Lines": (lines, dedupe.keep_first(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")),
        "Orders": (orders, dedupe.keep_first(orders, ["o_orderkey"], "o_orderdate")),
    }
    entries = [
        quality.row_count_entry(df, name, stage)
        for name, pair in firsts.items()
        for stage, df in zip(("raw", "cleaned"), pair, strict=True)
    ]
    return quality.stage_summary(reduce(DataFrame.unionByName, entries))


@query(
    "a27_rollup_calendar",
    f"""SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, month(o_orderdate) AS month,
    CASE WHEN grouping(year(o_orderdate)) = 1 THEN 0 WHEN grouping(quarter(o_orderdate)) = 1 THEN 1
      WHEN grouping(month(o_orderdate)) = 1 THEN 2 ELSE 3 END AS level,
    count(*) AS bookings, CAST(sum({MONEY_PRICE}) AS DOUBLE) AS booked, count(DISTINCT o_custkey) AS customers
    FROM orders GROUP BY ROLLUP (year(o_orderdate), quarter(o_orderdate), month(o_orderdate))""",
)
def a27(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
        F.month("o_orderdate").alias("month"),
        "o_custkey",
        money("o_totalprice").alias("price"),
    )
    return drilldown.drill_down(
        orders,
        ["year", "quarter", "month"],
        {"bookings": count_rows(), "booked": F.sum("price")},
        {"customers": "o_custkey"},
    )


@query(
    "a27_rollup_region_route",
    over(
        "dim_route dim_region",
        """SELECT r.name AS region, t.name AS route, CASE WHEN grouping(r.name) = 1 THEN 0 WHEN grouping(t.name) = 1 THEN 1 ELSE 2 END AS level,
        count(*) AS bookings, count(DISTINCT l_suppkey) AS guides FROM lineitem JOIN dim_route t ON l_partkey = route_id
        JOIN dim_region r USING (region_id) GROUP BY ROLLUP (r.name, t.name)""",
    ),
)
def a27_route(spark, sf):
    routes = lookup.lookup(
        tpch.dim_route(spark, sf), "region_id", tpch.dim_region(spark, sf), "region_id", {"name": "region"}
    ).select("route_id", "region", F.col("name").alias("route"))
    # Bookings per guide and route first: counts add up, and the distinct guides survive.
    per_pair = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("route_id"), "l_suppkey").agg(count_rows().alias("n"))
    return drilldown.drill_down(
        per_pair.join(routes, "route_id"),
        ["region", "route"],
        {"bookings": F.sum("n")},
        {"guides": "l_suppkey"},
    )


@query(
    "a28_grand_total",
    f"SELECT count(*) AS total_bookings, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {MONEY_PRICE} END) AS DOUBLE) AS revenue FROM orders",
)
def a28(spark, sf):
    return measures.measures(tpch.order_star(spark, sf, region=False), ["total_bookings", "revenue"])


# ------------------------------------------------------------------ windows


@query(
    "w01_rank_within_region",
    over(
        "lines_fact dim_region dim_route",
        """SELECT region, route, revenue, revenue_rank FROM (SELECT r.name AS region, t.name AS route, CAST(sum(total_price) AS DOUBLE) AS revenue,
        rank() OVER (PARTITION BY r.name ORDER BY sum(total_price) DESC) AS revenue_rank
        FROM lines_fact f JOIN dim_route t USING (route_id) JOIN dim_region r ON f.region_id = r.region_id
        WHERE status = 'confirmed' GROUP BY 1, 2) WHERE revenue_rank <= 5""",
    ),
)
def w01(spark, sf):
    per_route = reports.route_revenue(tpch.line_star(spark, sf)).groupBy("region", "route").agg(F.sum("revenue").alias("revenue"))
    return ranking.top_ranked(per_route, ["region"], [F.desc("revenue")], 5, "revenue_rank")


@query(
    "w02_row_number_leaderboard",
    f"""SELECT n_name, s_name, row_number() OVER (PARTITION BY n_name ORDER BY s_acctbal DESC, s_suppkey) AS place
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def w02(spark, sf):
    guides = lookup.lookup(
        table(spark, sf, "supplier"), "s_nationkey", table(spark, sf, "nation"), "n_nationkey", {"n_name": "n_name"}
    ).select("n_name", "s_name", "s_acctbal", "s_suppkey")
    placed = ranking.numbered(guides, "place", [F.desc("s_acctbal"), F.asc("s_suppkey")], by=["n_name"])
    return placed.select("n_name", "s_name", "place")


@query(
    "w03_booking_sequence_per_customer",
    """SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS booking_sequence
    FROM orders WHERE o_orderstatus IN ('F','O')""",
)
def w03(spark, sf):
    trips = table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    rows = trips.select("o_orderkey", "o_custkey", "o_orderdate")
    order = [F.asc("o_orderdate"), F.asc("o_orderkey")]
    return ranking.numbered(rows, "booking_sequence", order, by=["o_custkey"]).drop("o_orderdate")


@query(
    "w04_lag_prior_month",
    f"""SELECT ym, revenue, prior, {rnd("100 * (revenue - prior) / NULLIF(prior, 0)", 1)} AS change_pct FROM (
    SELECT ym, revenue, lag(revenue) OVER (ORDER BY ym) AS prior FROM (SELECT strftime(l_shipdate, '%Y-%m') AS ym,
    CAST(sum({NET}) AS DOUBLE) AS revenue FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1))""",
)
def w04(spark, sf):
    won = table(spark, sf, "lineitem").where("l_returnflag = 'A'")
    months = won.groupBy(dates.year_month("l_shipdate").alias("ym")).agg(F.sum(_net()).alias("revenue"))
    lagged = series.prior_period(months, ["ym"], "revenue", "prior")
    return lagged.withColumn("change_pct", series.growth_pct(F.col("revenue"), F.col("prior")))


@query(
    "w05_lead_next_booking",
    """SELECT o_custkey AS customer_id, day, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS next_day FROM
    (SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders WHERE o_orderstatus IN ('F','O'))""",
)
def w05(spark, sf):
    trips = table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("day")
    )
    days = series.event_days(trips, "customer_id", "day")
    return series.next_day(days, "customer_id", "day", "next_day").drop("n")


WEEK_START = "d - ((isodow(d) % 7)::INTEGER)"


@query(
    "w06_dense_rank_of_week",
    over(
        "days",
        f"""SELECT d AS full_date, dense_rank() OVER (PARTITION BY year({WEEK_START}) ORDER BY {WEEK_START}) AS week_number FROM days""",
    ),
)
def w06(spark, sf):
    return tpch.dim_date(spark, sf).select("full_date", "week_number")


@query(
    "w07_group_statistic_on_rows",
    """SELECT p_partkey, p_retailprice, median(p_retailprice) OVER (PARTITION BY p_brand) AS brand_median FROM part""",
)
def w07(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    medians = median.group_median(part, ["p_brand"], "p_retailprice", "brand_median")
    return part.join(medians, "p_brand").drop("p_brand")


@query(
    "w08_year_to_date",
    f"""SELECT day, CAST(rev AS DOUBLE) AS revenue, CAST(sum(rev) OVER (PARTITION BY year(day) ORDER BY day) AS DOUBLE) AS revenue_ytd
    FROM (SELECT o_orderdate::DATE AS day, sum({MONEY_PRICE}) AS rev FROM orders GROUP BY 1)""",
)
def w08(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("revenue"))
    return series.year_to_date(daily.withColumn("year", F.year("day")), "year", "day", "revenue", "revenue_ytd").drop("year")


@query(
    "w09_same_month_last_year",
    f"""WITH m AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, CAST(sum({MONEY_PRICE}) AS DOUBLE) AS revenue
    FROM orders GROUP BY 1, 2) SELECT a.year, a.month, a.revenue, b.revenue AS last_year FROM m a
    LEFT JOIN m b ON b.year = a.year - 1 AND b.month = a.month""",
)
def w09(spark, sf):
    months = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.sum(money("o_totalprice")).alias("revenue")
    )
    return series.same_period_last_year(months, "year", "revenue", "last_year", ["month"])


@query(
    "w10_year_over_year",
    f"""SELECT year, revenue, prior, {rnd("100 * (revenue - prior) / prior", 1)} AS yoy_pct FROM (
    SELECT year, revenue, lag(revenue) OVER (ORDER BY year) AS prior FROM (SELECT year(l_shipdate) AS year,
    CAST(sum({MONEY_LIST}) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1))""",
)
def w10(spark, sf):
    years = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        F.sum(money("l_extendedprice")).alias("revenue")
    )
    lagged = series.prior_period(years, ["year"], "revenue", "prior")
    return lagged.withColumn("yoy_pct", series.growth_pct(F.col("revenue"), F.col("prior")))


@query(
    "w11_share_of_total",
    f"""SELECT c_mktsegment, {rnd(div(f"sum({MONEY_PRICE})", f"(SELECT sum({MONEY_PRICE}) FROM orders)"), 4)} AS share
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def w11(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spent"))
    segments = per_customer.join(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    per_segment = segments.groupBy("c_mktsegment").agg(F.sum("spent").alias("spent"))
    return series.share_of_total(per_segment, "spent", "share", 4).drop("spent")


@query(
    "w12_surrogate_key_by_order",
    "SELECT c_custkey, row_number() OVER (ORDER BY reverse(c_name)) AS customer_id FROM customer",
)
def w12(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", F.reverse("c_name").alias("sort_name"))
    return ranking.numbered(people, "customer_id", [F.asc("sort_name")]).drop("sort_name")


# ------------------------------------------------------------------ sort, limit, top-k


@query(
    "o01_multi_key_sort",
    "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2",
)
def o01(spark, sf):
    months = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return months.agg(count_rows().alias("n")).orderBy("year", "month")


@query(
    "o02_sort_by_measure",
    f"SELECT o_orderpriority, CAST(sum({MONEY_PRICE}) AS DOUBLE) AS revenue FROM orders GROUP BY 1 ORDER BY 2 DESC",
)
def o02(spark, sf):
    sums = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.sum(money("o_totalprice")).alias("revenue"))
    return sums.orderBy(F.desc("revenue"))


@query(
    "o03_sort_limit_50",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
)
def o03(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query(
    "o04_top_k_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, r FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r
    FROM orders) WHERE r <= 2""",
)
def o04(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_ranked(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2, "r")


@query(
    "o05_best_route",
    """(SELECT 'bookings' AS kind, l_partkey AS route_id, CAST(count(*) AS DOUBLE) AS value FROM lineitem GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)
    UNION ALL (SELECT 'revenue', l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem
    WHERE l_returnflag = 'A' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)""",
)
def o05(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "route_id")
    popular = lines.groupBy("route_id").agg(count_rows().cast("double").alias("value"))
    earning = lines.where("l_returnflag = 'A'").groupBy("route_id").agg(
        F.sum(money("l_extendedprice")).cast("double").alias("value")
    )
    tops = [
        ranking.best(df, [], ["route_id"], "value", "route_id").select(F.lit(kind).alias("kind"), "route_id", "value")
        for kind, df in (("bookings", popular), ("revenue", earning))
    ]
    return tops[0].unionByName(tops[1])


@query(
    "o05_highest_rated_route",
    over(
        "reviews",
        f"""SELECT route_id, avg_rating FROM (SELECT l_partkey AS route_id, {rnd(div("sum(route_rating)", "count(route_rating)"), 4)} AS avg_rating
        FROM lineitem JOIN reviews ON l_orderkey = booking_id GROUP BY 1) ORDER BY avg_rating DESC NULLS LAST, route_id LIMIT 1""",
    ),
)
def o05_rated(spark, sf):
    rated = tpch.line_reviews(spark, sf).groupBy("route_id").agg(
        rate(F.sum("route_rating"), F.count("route_rating")).alias("avg_rating")
    )
    return ranking.best(rated.where("avg_rating IS NOT NULL"), [], ["route_id"], "avg_rating", "route_id")


@query(
    "o06_label_sorted_by_companion",
    "SELECT dayname(o_orderdate) AS day_name, isodow(o_orderdate) - 1 AS day_of_week, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 2",
)
def o06(spark, sf):
    day = F.to_date("o_orderdate")
    days = table(spark, sf, "orders").groupBy(dates.day_name(day).alias("day_name"), F.weekday(day).cast("bigint").alias("day_of_week"))
    return days.agg(count_rows().alias("n")).orderBy("day_of_week")


@query(
    "o07_top_n_and_other",
    """WITH s AS (SELECT p_brand AS brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY n DESC, brand) AS k FROM s)
    SELECT CASE WHEN k <= 10 THEN brand ELSE 'Other' END AS brand, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""",
)
def o07(spark, sf):
    per_route = table(spark, sf, "lineitem").groupBy("l_partkey").agg(count_rows().alias("n"))
    brands = per_route.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_brand").alias("brand")
    )
    return ranking.top_n_and_other(brands.agg(F.sum("n").alias("n")), "brand", "n", 10)


@query(
    "o08_first_failures",
    """SELECT * FROM (SELECT 'l_discount' AS "column", 'between(0, 0.09)' AS "check", CAST(l_discount AS VARCHAR) AS value, count(*) AS rows
      FROM lineitem WHERE l_discount > 0.09 GROUP BY 3
    UNION ALL SELECT 'l_quantity', 'between(1, 42)', CAST(l_quantity AS VARCHAR), count(*) FROM lineitem WHERE l_quantity > 42 GROUP BY 3)
    ORDER BY 1, 2, 3 LIMIT 5""",
)
def o08(spark, sf):
    contract = Contract(
        {"l_discount": Field("DOUBLE", (between(0, 0.09),)), "l_quantity": Field("DOUBLE", (between(1, 42),))}
    )
    return validation.first_failures(table(spark, sf, "lineitem"), contract, 5)


# ------------------------------------------------------------------ set operations


@query(
    "u01_date_span_union",
    """SELECT min(lo)::DATE AS lo, max(hi)::DATE AS hi FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders
    UNION ALL SELECT min(l_shipdate), max(l_shipdate) FROM lineitem UNION ALL SELECT min(ts), max(ts) FROM events)""",
)
def u01(spark, sf):
    from starmart.functions.calendar import date_span

    columns = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return date_span(*[(table(spark, sf, t), c) for t, c in columns.items()])


@query(
    "u02_any_of_several",
    """SELECT count(*) AS n FROM lineitem WHERE l_discount = 0.1 OR l_tax = 0.08 OR l_quantity = 50""",
)
def u02(spark, sf):
    predicates = [F.col("l_discount") == 0.1, F.col("l_tax") == 0.08, F.col("l_quantity") == 50]
    return table(spark, sf, "lineitem").where(reduce(lambda a, b: a | b, predicates)).agg(count_rows().alias("n"))


@query("u03_union_of_yearly_sets", over("holidays", "SELECT DISTINCT d AS full_date FROM holidays"))
def u03(spark, sf):
    from starmart.functions.calendar import bank_holidays

    years = tpch.dim_date(spark, sf).select("year").distinct()
    return bank_holidays(years).select("full_date").distinct()


@query(
    "u04_set_difference",
    "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def u04(spark, sf):
    urgent = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return table(spark, sf, "customer").select("c_custkey").exceptAll(urgent.select(F.col("o_custkey").alias("c_custkey")).distinct())


