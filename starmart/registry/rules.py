"""Column rules applied to whole tables of messy text derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions import calendar, dates, numbers, text
from starmart.functions.numbers import count_rows, money
from starmart.operators import median
from starmart.plans import quality
from starmart.registry import query
from starmart.registry.sql import MONEY_LIST, MONEY_PRICE, div, over, rnd, ymd
from starmart.sources import tpch
from starmart.sources.tpch import table

# ------------------------------------------------------------------ messy inputs, in both languages


def variant(key: str, *values: Column | str | None) -> Column:
    """The i-th spelling for rows whose key leaves remainder i."""
    pick = F.pmod(F.col(key), F.lit(len(values)))
    out = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(values))):
        cell = F.lit(v) if v is None or isinstance(v, str) else v
        out = F.when(pick == i, cell.cast("string")).otherwise(out)
    return out


def variant_sql(key: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


def raw_part_name() -> Column:
    n = F.col("p_name")
    return variant(
        "p_partkey",
        F.concat(F.lit("  "), F.upper(n), F.lit("\t")),
        F.concat(n, F.lit("'s o'neil-smith")),
        F.concat(F.lit("4000s "), n, F.lit(" x2y")),
        F.lit("   "),
        F.lit(None),
    )


RAW_PART_NAME = variant_sql(
    "p_partkey", "'  ' || upper(p_name) || chr(9)", "p_name || '''s o''neil-smith'", "'4000s ' || p_name || ' x2y'", "'   '", "NULL"
)


def raw_price(amount: str = "o_totalprice", key: str = "o_orderkey") -> Column:
    plain = money(amount).cast("string")
    return variant(
        key,
        F.concat(F.lit("£"), F.format_number(money(amount), 2)),
        F.concat(F.lit("GBP "), plain),
        F.concat(F.lit(" "), plain, F.lit(" gbp")),
        plain,
        F.lit("n/a"),
    )


RAW_PRICE = variant_sql(
    "o_orderkey", "'£' || format('{:,.2f}', o_totalprice)", f"'GBP ' || {MONEY_PRICE}", f"' ' || {MONEY_PRICE} || ' gbp'",
    f"CAST({MONEY_PRICE} AS VARCHAR)", "'n/a'",
)
READ_PRICE = f"CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST({MONEY_PRICE} AS DOUBLE) END"


def raw_email() -> Column:
    local = F.concat(F.lit("customer."), F.col("c_custkey").cast("string"))
    return variant(
        "c_custkey",
        F.concat(local, F.lit("@example.com")),
        F.concat(local, F.lit(" at example.com")),
        F.concat(F.lit("  "), F.initcap(local), F.lit("@Example.com ")),
        F.concat(local, F.lit(" at post at example.com")),
        F.concat(F.lit("x at "), local, F.lit("@example.com")),
        F.lit("not-an-email"),
        F.lit(None),
    )


RAW_EMAIL = variant_sql(
    "c_custkey",
    "'customer.' || c_custkey || '@example.com'", "'customer.' || c_custkey || ' at example.com'",
    "'  Customer.' || c_custkey || '@Example.com '", "'customer.' || c_custkey || ' at post at example.com'",
    "'x at customer.' || c_custkey || '@example.com'", "'not-an-email'", "NULL",
)

COUNTRY_SPELLINGS = (
    "UK", " u.k. ", "Great Britain", "england", "United Kingdom", "usa", "U.S.A.", "us", "United States of America",
    "united states", "Deutschland", "DE", "germany", "fr", "FRANCE", "Republic of Ireland", "ie", "Ireland", "neverland", None,
)
COUNTRY_RESULTS = ["United Kingdom"] * 5 + ["United States"] * 5 + ["Germany"] * 3 + ["France"] * 2 + ["Ireland"] * 3


def quoted(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


# ------------------------------------------------------------------ text

CASED = "[\\p{Lu}\\p{Ll}\\p{Lt}]"


def title_sql(x: str) -> str:
    runs = f"regexp_extract_all({x}, '{CASED}+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+')"
    return (
        f"array_to_string(list_transform({runs}, lambda t: "
        "CASE WHEN t[1] = 'ß' THEN 'Ss' ELSE upper(t[1]) END || lower(t[2:])), '')"
    )


STRIPPED_NAME = f"regexp_replace({RAW_PART_NAME}, '^\\s+|\\s+$', '', 'g')"


@query("f01_title_case", f"SELECT p_partkey, {title_sql(f'nullif({STRIPPED_NAME}, {quoted('')})')} AS name FROM part")
def f01(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", raw_part_name().alias("raw"))
    return part.select("p_partkey", text.titled("raw").alias("name"))


@query("f01_title_case_whole_texts", f"SELECT doc_id, md5({title_sql('text')}) AS digest FROM documents")
def f01_texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.capitalised("text")).alias("digest"))


@query("f02_strip_lower", f"SELECT p_partkey, lower({STRIPPED_NAME}) AS name FROM part")
def f02(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.lowered(raw_part_name()).alias("name"))


@query("f03_parse_currency", f"SELECT o_orderkey, {READ_PRICE} AS price, o_orderkey % 5 < 3 AS had_mark FROM orders")
def f03(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", raw_price().alias("raw"))
    return orders.select(
        "o_orderkey", numbers.currency("raw").alias("price"), numbers.has_currency_mark("raw").alias("had_mark")
    )


@query(
    "f04_strict_rate",
    """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderkey % 5 = 4) AS unreadable, count(*) AS rows FROM orders GROUP BY 1""",
)
def f04(spark, sf):
    read = numbers.currency(raw_price())
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count_if(read.isNull()).alias("unreadable"), count_rows().alias("rows")
    )


@query(
    "f05_parse_distance",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_size + 0.5::DOUBLE END AS distance_km, p_partkey % 4 < 2 AS had_unit FROM part",
)
def f05(spark, sf):
    half = (F.col("p_size") + F.lit(0.5)).cast("string")
    raw = variant("p_partkey", F.concat(half, F.lit(" km")), F.concat(F.lit(" "), half, F.lit("KM ")), half, F.lit("far"))
    part = table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return part.select(
        "p_partkey", numbers.distance_km("raw").alias("distance_km"), numbers.has_distance_unit("raw").alias("had_unit")
    )


@query(
    "f06_parse_yes_no",
    "SELECT event_id, CASE WHEN event_id % 10 < 4 THEN true WHEN event_id % 10 < 8 THEN false END AS answer FROM events",
)
def f06(spark, sf):
    raw = variant("event_id", "Yes", " y", "TRUE", "1", "  NO ", "n", "False", "0", "maybe", None)
    return table(spark, sf, "events").select("event_id", numbers.yes_no(raw).alias("answer"))


@query(
    "f07_clean_email",
    """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'customer.' || c_custkey || '@example.com' WHEN 1 THEN 'customer.' || c_custkey || '@example.com'
    WHEN 2 THEN 'Customer.' || c_custkey || '@Example.com' WHEN 3 THEN 'customer.' || c_custkey || ' at post at example.com'
    WHEN 4 THEN 'x at customer.' || c_custkey || '@example.com' WHEN 5 THEN 'not-an-email' END AS email, c_custkey % 7 > 2 AS invalid FROM customer""",
)
def f07(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", raw_email().alias("raw"))
    address, invalid = text.email("raw")
    return people.select("c_custkey", address.alias("email"), invalid.alias("invalid"))


@query(
    "f08_canonical_country",
    f"""SELECT c_custkey, {variant_sql("c_custkey", *[quoted(c) for c in [*COUNTRY_RESULTS, "Neverland", None]])} AS country,
    c_custkey % 20 >= 18 AS unrecognised FROM customer""",
)
def f08(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", variant("c_custkey", *COUNTRY_SPELLINGS).alias("raw"))
    name, unknown = text.country("raw")
    return people.select("c_custkey", name.alias("country"), unknown.alias("unrecognised"))


@query("f09_slug", "SELECT p_partkey, replace(lower(p_name), ' ', '-') AS slug FROM part")
def f09(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.slug("p_name").alias("slug"))


@query("f10_strip", f"SELECT p_partkey, {STRIPPED_NAME} AS name FROM part")
def f10(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.stripped(raw_part_name()).alias("name"))


@query("f11_strip_upper", f"SELECT p_partkey, upper({STRIPPED_NAME}) AS name FROM part")
def f11(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.uppered(raw_part_name()).alias("name"))


@query(
    "f12_full_name",
    "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' ' || p_name END AS full_name FROM part",
)
def f12(spark, sf):
    last = variant("p_partkey", F.col("p_name"), None)
    return table(spark, sf, "part").select("p_partkey", text.full_name("p_brand", last).alias("full_name"))


@query("f13_email_key", f"SELECT c_custkey, lower(trim(coalesce({RAW_EMAIL}, ''))) AS email_key FROM customer")
def f13(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.email_key(raw_email()).alias("email_key"))


# ------------------------------------------------------------------ numbers


@query(
    "f14_clip_to_unit",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN value / 100 - 0.1 < 0 THEN 0 WHEN value / 100 - 0.1 > 1 THEN 1
    ELSE value / 100 - 0.1 END AS share FROM events""",
)
def f14(spark, sf):
    share = F.when(F.col("event_type") != "error", F.col("value") / 100 - 0.1)
    return table(spark, sf, "events").select("event_id", numbers.clipped(share).alias("share"))


@query(
    "f15_fill_with_group_median",
    """WITH p AS (SELECT p_partkey, p_type, CASE WHEN p_size > 10 THEN p_size END AS size FROM part)
    SELECT p_partkey, coalesce(CAST(size AS DOUBLE), median(size) OVER (PARTITION BY p_type)) AS size FROM p""",
)
def f15(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_type", F.when(F.col("p_size") > 10, F.col("p_size")).cast("double").alias("size")
    )
    medians = median.group_median(part, ["p_type"], "size", "fill")
    return part.join(medians, "p_type", "left").select("p_partkey", F.coalesce("size", "fill").alias("size"))


@query("f16_truncating_cast", "SELECT s_suppkey, CAST(trunc(s_acctbal) AS INTEGER) AS whole FROM supplier")
def f16(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", numbers.whole("s_acctbal").alias("whole"))


@query(
    "f17_tolerant_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 4 < 2 THEN o_orderdate END AS moment FROM orders""",
)
def f17(spark, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = variant("o_orderkey", iso, F.concat(iso, F.lit(" 00:00:00")), F.lit("2024-13-45"), F.lit("soon"))
    orders = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select("o_orderkey", dates.tolerant_date("raw").alias("day"), dates.tolerant_timestamp("raw").alias("moment"))


@query(
    "f18_year_month_to_first",
    "SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY 1",
)
def f18(spark, sf):
    month = dates.month_start(F.date_format("o_orderdate", "yyyy-MM"))
    return table(spark, sf, "orders").groupBy(month.alias("month")).agg(count_rows().alias("n"))


# ------------------------------------------------------------------ dates


@query("f19_date_key", f"SELECT o_orderkey, {ymd('o_orderdate')} AS date_id FROM orders")
def f19(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.date_key("o_orderdate").alias("date_id"))


@query("f20_truncate_to_day", "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1")
def f20(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(count_rows().alias("n"))


@query(
    "f21_day_difference",
    """SELECT date_diff('day', o_orderdate, l_shipdate) AS lead_days, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def f21(spark, sf):
    lines = tpch.line_bookings(spark, sf, region=False, order=True)
    return lines.groupBy(F.col("lead_time_days").cast("bigint").alias("lead_days")).agg(count_rows().alias("n"))


@query(
    "f22_calendar_parts",
    """SELECT DISTINCT l_shipdate::DATE AS d, day(l_shipdate) AS day, month(l_shipdate) AS month, monthname(l_shipdate) AS month_name,
    quarter(l_shipdate) AS quarter, year(l_shipdate) AS year, isodow(l_shipdate) - 1 AS day_of_week, dayname(l_shipdate) AS day_name FROM lineitem""",
)
def f22(spark, sf):
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    return days.select(
        "d", F.day("d").alias("day"), F.month("d").alias("month"), dates.month_name("d").alias("month_name"),
        F.quarter("d").alias("quarter"), F.year("d").alias("year"), F.weekday("d").alias("day_of_week"),
        dates.day_name("d").alias("day_name"),
    )


@query("f23_year_month_text", "SELECT strftime(ts, '%Y-%m') AS ym, count(*) AS n FROM events GROUP BY 1")
def f23(spark, sf):
    return table(spark, sf, "events").groupBy(dates.year_month("ts").alias("ym")).agg(count_rows().alias("n"))


@query(
    "f24_months_back_with_carry",
    """SELECT DISTINCT l_shipdate::DATE AS d, (date_trunc('month', l_shipdate) - INTERVAL 13 MONTH)::DATE + (day(l_shipdate) - 1)::INTEGER AS back FROM lineitem""",
)
def f24(spark, sf):
    from starmart.plans.reports import months_back

    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    return days.withColumn("back", months_back(F.col("d"), 13))


@query(
    "f25_run_stamp",
    """SELECT 'Orders' AS "table", 'row_count' AS metric, CAST(count(*) AS DOUBLE) AS value, true AS stamped FROM orders""",
)
def f25(spark, sf):
    entry = quality.row_count_entry(table(spark, sf, "orders"), "Orders", "raw")
    return entry.select("table", "metric", "value", (F.col("run_started_at") <= F.current_timestamp()).alias("stamped"))


@query(
    "f26_meteorological_season",
    """SELECT ['Winter','Spring','Summer','Autumn'][(month(l_shipdate) % 12) // 3 + 1] AS season, count(*) AS n FROM lineitem GROUP BY 1""",
)
def f26(spark, sf):
    season = dates.calendar_season(F.month("l_shipdate"))
    return table(spark, sf, "lineitem").groupBy(season.alias("season")).agg(count_rows().alias("n"))


@query(
    "f27_trading_season",
    """SELECT CASE WHEN month(l_shipdate) BETWEEN 4 AND 10 THEN 'Summer season' ELSE 'Winter season' END AS season, count(*) AS n FROM lineitem GROUP BY 1""",
)
def f27(spark, sf):
    season = dates.trading_season(F.month("l_shipdate"))
    return table(spark, sf, "lineitem").groupBy(season.alias("season")).agg(count_rows().alias("n"))


@query("f28_weekend_flag", "SELECT isodow(l_shipdate) > 5 AS is_weekend, count(*) AS n FROM lineitem GROUP BY 1")
def f28(spark, sf):
    flag = dates.is_weekend(F.to_date("l_shipdate"))
    return table(spark, sf, "lineitem").groupBy(flag.alias("is_weekend")).agg(count_rows().alias("n"))


@query(
    "f29_retail_week",
    """SELECT week_start, week_start + 6 AS week_end, year(week_start) AS retail_year, count(*) AS n FROM
    (SELECT l_shipdate::DATE - dayofweek(l_shipdate)::INTEGER AS week_start FROM lineitem) GROUP BY 1""",
)
def f29(spark, sf):
    start = dates.retail_week_start(F.to_date("l_shipdate"))
    weeks = table(spark, sf, "lineitem").groupBy(start.alias("week_start")).agg(count_rows().alias("n"))
    return weeks.select("week_start", F.date_add("week_start", 6).alias("week_end"), F.year("week_start").alias("retail_year"), "n")


def order_years(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query(
    "f30_easter_sunday",
    over("years easter", "SELECT y AS year, sunday FROM easter WHERE y IN (SELECT year(o_orderdate) FROM orders)"),
)
def f30(spark, sf):
    return order_years(spark, sf).select("year", calendar.easter_sunday("year").alias("sunday"))


@query(
    "f31_nth_monday",
    """SELECT y AS year, min(d) AS first_monday, min(d) + 7 AS second_monday FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    LATERAL (SELECT unnest(generate_series(make_date(y,5,1), make_date(y,5,31), INTERVAL 1 DAY))::DATE AS d) WHERE isodow(d) = 1 GROUP BY 1""",
)
def f31(spark, sf):
    return order_years(spark, sf).select(
        "year", calendar.nth_monday("year", 5).alias("first_monday"), calendar.nth_monday("year", 5, 2).alias("second_monday")
    )


@query(
    "f32_last_monday",
    """SELECT y AS year, max(d) FILTER (WHERE month(d) = 5) AS in_may, max(d) FILTER (WHERE month(d) = 8) AS in_august
    FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    LATERAL (SELECT unnest(generate_series(make_date(y,5,1), make_date(y,8,31), INTERVAL 1 DAY))::DATE AS d) WHERE isodow(d) = 1 GROUP BY 1""",
)
def f32(spark, sf):
    return order_years(spark, sf).select(
        "year", calendar.last_monday("year", 5).alias("in_may"), calendar.last_monday("year", 8).alias("in_august")
    )


@query(
    "f33_weekend_substitutes",
    over(
        "holidays",
        """SELECT year, max(d) FILTER (WHERE holiday LIKE 'New Year%') AS new_year, max(d) FILTER (WHERE holiday LIKE 'Christmas%') AS christmas,
        max(d) FILTER (WHERE holiday LIKE 'Boxing%') AS boxing FROM holidays WHERE year IN (SELECT year(o_orderdate) FROM orders) GROUP BY 1""",
    ),
)
def f33(spark, sf):
    return order_years(spark, sf).select(
        "year",
        calendar.new_year_observed("year").alias("new_year"),
        calendar.christmas_observed("year").alias("christmas"),
        calendar.boxing_observed("year").alias("boxing"),
    )


@query("f34_bank_holidays", over("holidays", "SELECT year, holiday, d AS full_date FROM holidays WHERE year IN (SELECT year(o_orderdate) FROM orders)"))
def f34(spark, sf):
    return calendar.bank_holidays(order_years(spark, sf))


@query(
    "f35_summer_holiday",
    "SELECT strftime(l_shipdate, '%m%d') BETWEEN '0720' AND '0831' AS is_summer_holiday, count(*) AS n FROM lineitem GROUP BY 1",
)
def f35(spark, sf):
    flag = dates.is_summer_holiday("l_shipdate")
    return table(spark, sf, "lineitem").groupBy(flag.alias("is_summer_holiday")).agg(count_rows().alias("n"))


@query(
    "f36_lead_time_bucket",
    over(
        "orders_fact",
        """SELECT CASE WHEN lead_time_days > 90 THEN '90+ days' WHEN lead_time_days > 30 THEN '31-90 days' WHEN lead_time_days > 7 THEN '8-30 days'
        ELSE '0-7 days' END AS bucket, count(*) AS n FROM orders_fact GROUP BY 1""",
    ),
)
def f36(spark, sf):
    bookings = tpch.order_bookings(spark, sf, region=False)
    return bookings.groupBy(dates.lead_time_bucket("lead_time_days").alias("bucket")).agg(count_rows().alias("n"))


@query(
    "f37_experience_band",
    """SELECT CASE WHEN p_size >= 15 THEN 'Veteran (15+ yrs)' WHEN p_size >= 5 THEN 'Experienced (5-15 yrs)' ELSE 'Junior (<5 yrs)' END AS band,
    count(*) AS n FROM part GROUP BY 1""",
)
def f37(spark, sf):
    return table(spark, sf, "part").groupBy(dates.experience_band("p_size").alias("band")).agg(count_rows().alias("n"))


# ------------------------------------------------------------------ null handling, division, rounding


@query(
    "f38_coalesce_nullif_case",
    """SELECT doc_id, coalesce(quality, -1) AS quality, nullif(toxic, 0) AS toxic, CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad'
    ELSE 'unknown' END AS verdict FROM documents LEFT JOIN labels USING (doc_id)""",
)
def f38(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    quality_ = F.col("quality")
    verdict = F.when(quality_ == 1, "good").when(quality_ == 0, "bad").otherwise("unknown")
    return joined.select(
        "doc_id",
        F.coalesce(quality_, F.lit(-1)).alias("quality"),
        F.nullif(F.col("toxic"), F.lit(0)).alias("toxic"),
        verdict.alias("verdict"),
    )


@query(
    "f39_blank_on_zero_division",
    f"""SELECT l_suppkey, {div("count(*) FILTER (WHERE l_quantity = 50)", "count(*) FILTER (WHERE l_quantity = 1)")} AS ratio FROM lineitem GROUP BY 1""",
)
def f39(spark, sf):
    q = F.col("l_quantity")
    quotient = numbers.ratio(F.count_if(q == 50), F.count_if(q == 1))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(quotient.alias("ratio"))


@query(
    "f40_round_half_up",
    f"""SELECT l_returnflag, CAST(sum(round({MONEY_LIST} * CAST(l_tax AS DECIMAL(4,2)), 1)) AS DOUBLE) AS tax_1dp,
    {rnd(f"sum({MONEY_LIST})::DOUBLE / count(*)", 2)} AS avg_2dp FROM lineitem GROUP BY 1""",
)
def f40(spark, sf):
    tax = F.round(money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)"), 1)
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(tax).alias("tax_1dp"), numbers.avg_exact(money("l_extendedprice")).alias("avg_2dp")
    )


@query(
    "f41_absolute_tolerance",
    f"""SELECT l_discount, count(*) FILTER (WHERE abs({MONEY_LIST} * (1 - CAST(l_discount AS DECIMAL(4,2))) -
      round({MONEY_LIST} * (1 - CAST(l_discount AS DECIMAL(4,2))), 1)) > 0.02) AS mismatches FROM lineitem GROUP BY 1""",
)
def f41(spark, sf):
    net = money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
    off = F.count_if(numbers.differs(net, F.round(net, 1)))
    return table(spark, sf, "lineitem").groupBy("l_discount").agg(off.alias("mismatches"))
