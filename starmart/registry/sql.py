"""SQL building blocks of the oracle statements: the star roles as CTEs, and rounding."""

from __future__ import annotations

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'amended' ELSE 'cancelled' END"
LINE_STATUS = "CASE l_returnflag WHEN 'A' THEN 'confirmed' WHEN 'N' THEN 'pending' ELSE 'cancelled' END"


def ymd(d: str) -> str:
    """YYYYMMDD of a date expression."""
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def season(d: str) -> str:
    return f"CASE WHEN month({d}) >= 11 OR month({d}) <= 3 THEN 'winter' ELSE 'summer' END"


def rnd(x: str, places: int) -> str:
    """Round half away from zero in decimal, result double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    """Double quotient, NULL for a zero denominator."""
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def rate(a: str, b: str, places: int = 4) -> str:
    return rnd(div(a, b), places)


MONEY_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
MONEY_LIST = "CAST(l_extendedprice AS DECIMAL(18,2))"

CTES = {
    "dim_region": "SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name AS name FROM region",
    "dim_channel": (
        "SELECT * FROM (VALUES (CAST(1 AS BIGINT),'organic','unpaid'),(2,'direct','unpaid'),(3,'referral','unpaid'),"
        "(4,'paid_search','paid'),(5,'paid_social','paid'),(6,'email','paid')) v(channel_id,channel_name,channel_type)"
    ),
    "dim_customer": (
        "SELECT c_custkey AS customer_id, c_name AS contact_name, "
        "lower(replace(c_name,'#','.')) || '@example.com' AS contact_email FROM customer"
    ),
    "dim_guide": (
        "SELECT s_suppkey AS guide_id, s_name AS full_name, "
        "CAST(floor(abs(s_acctbal) / 400) AS INTEGER) AS years_experience, "
        "CASE WHEN s_nationkey < 12 THEN 'employed' ELSE 'freelance' END AS employment_type, "
        "abs(CAST(s_acctbal AS DECIMAL(18,2))) AS day_rate_gbp, CAST(n_regionkey AS BIGINT) AS primary_region_id, "
        "s_acctbal >= 0 AS active, floor(abs(s_acctbal) / 400) / 100.0::DOUBLE AS discount_tendency_pct "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey"
    ),
    "dim_route": (
        "SELECT p_partkey AS route_id, p_name AS name, CAST(p_size % 5 AS BIGINT) AS region_id, "
        "CASE WHEN p_type IN ('ECONOMY','SMALL') THEN 'moderate' WHEN p_type IN ('MEDIUM','STANDARD') THEN 'hard' "
        "ELSE 'advanced' END AS difficulty, CAST(p_size AS DOUBLE) AS distance_km FROM part"
    ),
    "span": (
        "SELECT least((SELECT min(o_orderdate::DATE - CAST(o_orderkey % 120 AS INTEGER)) FROM orders),"
        "(SELECT min(l_shipdate)::DATE FROM lineitem),(SELECT min(date_trunc('week', ts))::DATE FROM events))::DATE AS lo, "
        "greatest((SELECT max(o_orderdate)::DATE FROM orders),(SELECT max(l_shipdate)::DATE FROM lineitem),"
        "(SELECT max(ts)::DATE + 13 FROM events))::DATE AS hi"
    ),
    "days": "SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM span",
    "years": "SELECT unnest(generate_series(year(lo), year(hi))) AS y FROM span",
    # Easter by Oudin's formula, weekend shifts by weekday number.
    "easter": (
        "SELECT y, make_date(y, 3 + (l + 40) // 44, l + 28 - 31 * ((3 + (l + 40) // 44) // 4)) AS sunday FROM ("
        "SELECT y, i - ((y + y // 4 + i + 2 - c + c // 4) % 7) AS l FROM ("
        "SELECT y, c, h - (h // 28) * (1 - (h // 28) * (29 // (h + 1)) * ((21 - g) // 11)) AS i FROM ("
        "SELECT y, y % 19 AS g, y // 100 AS c, "
        "(y // 100 - y // 400 - (8 * (y // 100) + 13) // 25 + 19 * (y % 19) + 15) % 30 AS h FROM years)))"
    ),
    "fixed_days": (
        "SELECT y, make_date(y,1,1) AS ny, make_date(y,12,25) AS xmas, make_date(y,12,26) AS boxing, "
        "make_date(y,5,1) AS may1, make_date(y,5,31) AS may31, make_date(y,8,31) AS aug31 FROM years"
    ),
    "moved": (
        "SELECT *, ny + CASE isodow(ny) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS ny_o, "
        "xmas + CASE isodow(xmas) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS xmas_o, "
        "boxing + CASE isodow(boxing) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS boxing_1 FROM fixed_days"
    ),
    "holidays": (
        "SELECT y AS year, 'New Year''s Day' AS holiday, ny_o AS d FROM moved "
        "UNION ALL SELECT y, 'Good Friday', sunday - 2 FROM easter UNION ALL SELECT y, 'Easter Monday', sunday + 1 FROM easter "
        "UNION ALL SELECT y, 'Early May bank holiday', may1 + ((8 - isodow(may1)) % 7)::INTEGER FROM moved "
        "UNION ALL SELECT y, 'Spring bank holiday', may31 - (isodow(may31) - 1)::INTEGER FROM moved "
        "UNION ALL SELECT y, 'Summer bank holiday', aug31 - (isodow(aug31) - 1)::INTEGER FROM moved "
        "UNION ALL SELECT y, 'Christmas Day', xmas_o FROM moved "
        "UNION ALL SELECT y, 'Boxing Day', CASE WHEN boxing_1 = xmas_o THEN boxing_1 + 1 ELSE boxing_1 END FROM moved"
    ),
    "orders_fact": (
        f"SELECT o_orderkey AS booking_id, 'B-' || o_orderkey AS booking_reference, o_custkey AS customer_id, "
        f"CAST(left(o_orderpriority,1) AS BIGINT) AS channel_id, {STATUS} AS status, o_orderdate::DATE AS tour_date, "
        f"(o_orderdate::DATE - CAST(o_orderkey % 120 AS INTEGER)) AS created_date, "
        f"CAST(o_orderkey % 120 AS INTEGER) AS lead_time_days, "
        f"{season('o_orderdate')} AS season, CAST(o_orderkey % 3 + 1 AS INTEGER) AS party_size, "
        f"{MONEY_PRICE} AS total_price, CAST(n_regionkey AS BIGINT) AS region_id "
        f"FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    ),
    "lines_fact": (
        f"SELECT l_orderkey AS booking_id, l_linenumber AS line, l_partkey AS route_id, l_suppkey AS guide_id, "
        f"{LINE_STATUS} AS status, l_shipdate::DATE AS tour_date, o_orderdate::DATE AS created_date, "
        f"o_custkey AS customer_id, CAST(left(o_orderpriority,1) AS BIGINT) AS channel_id, "
        f"{season('l_shipdate')} AS season, CAST(CAST(l_quantity AS INTEGER) % 3 + 1 AS INTEGER) AS party_size, "
        f"{MONEY_LIST} AS list_price, l_discount AS discount_pct, l_discount > 0 AS discount_applied, "
        f"CAST({MONEY_LIST} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS total_price, "
        f"CAST(n_regionkey AS BIGINT) AS region_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        f"JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
    ),
    "reviews": (
        "SELECT d.doc_id AS booking_id, 2 + 2 * quality + n_chars % 2 AS overall_rating, "
        "5 - 3 * toxic - n_chars % 2 AS guide_rating, 1 + 3 * quality + n_chars % 2 AS route_rating, "
        "n_chars % 5 + 1 AS safety_rating, 1 + 4 * quality AS value_rating, n_chars AS comment_length, "
        "quality = 1 AS would_recommend FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    ),
    "payments": (
        "SELECT event_id AS payment_id, event_id AS booking_id, CAST(value AS DECIMAL(18,2)) AS amount, "
        "CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' "
        "WHEN 'view' THEN 'refunded' ELSE 'refund_pending' END AS status, "
        "CASE WHEN event_type IN ('purchase','view') THEN ts::DATE END AS paid_date, "
        "CASE WHEN event_type = 'view' THEN ts::DATE + CAST(event_id % 14 AS INTEGER) END AS refunded_date FROM events"
    ),
    "equipment": (
        "SELECT event_id AS booking_id, CAST(value AS DECIMAL(18,2)) AS hire_revenue "
        "FROM events WHERE event_type = 'purchase'"
    ),
    "marketing": (
        f"SELECT CAST(left(o_orderpriority,1) AS BIGINT) AS channel_id, date_trunc('month', o_orderdate)::DATE AS month, "
        f"sum(CASE WHEN left(o_orderpriority,1) >= '4' AND o_orderstatus = 'P' THEN {MONEY_PRICE} ELSE 0 END) AS spend, "
        f"count(*) * 25 AS clicks, count(*) * 400 AS impressions, "
        f"count(*) FILTER (WHERE o_orderstatus <> 'P') AS conversions, "
        f"sum(CASE WHEN o_orderstatus <> 'P' THEN {MONEY_PRICE} ELSE 0 END) AS revenue FROM orders GROUP BY 1, 2"
    ),
    "website": (
        "SELECT date_trunc('week', ts)::DATE AS week, CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 "
        "WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS BIGINT) AS channel_id, "
        "CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device, "
        "count(*) AS sessions, count(DISTINCT user_id) AS users, "
        "count(*) FILTER (WHERE value < 10) / count(*) AS bounce_rate, "
        "count(*) FILTER (WHERE value > 100) / count(*) AS conversion_rate FROM events GROUP BY ALL"
    ),
    "weather": (
        "SELECT l_shipdate::DATE AS d, CAST(n_regionkey AS BIGINT) AS region_id, max(l_quantity) - 20 AS temperature_c, "
        "min(l_quantity) AS rain_mm, max(l_discount) >= 0.1 AND max(l_tax) >= 0.08 AS storm_warning "
        "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2"
    ),
}


def over(ctes: str, body: str) -> str:
    """``body`` over the named star roles (space separated)."""
    names = ctes.split()
    if "holidays" in names:
        names = [*("years", "easter", "fixed_days", "moved"), *names]
    if {"days", "years"} & set(names) and "span" not in names:
        names.insert(0, "span")
    head = ", ".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {head} {body}" if not body.lstrip().startswith(",") else f"WITH {head}{body.lstrip()}"
