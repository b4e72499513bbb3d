"""Cleaning of whole messy tables, the quality log, and contract validation."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.numbers import count_rows
from starmart.operators import dedupe
from starmart.plans import cleaning, ledger, pipeline, quality, reports, validation
from starmart.plans.cleaning import ORDINAL
from starmart.registry import messy, query
from starmart.registry.rules import quoted
from starmart.registry.sql import over
from starmart.schemas import CLEAN, RAW, STAR, Contract, Field, above, between, one_of
from starmart.session import removed, shared_path, written
from starmart.sources import files, tpch
from starmart.sources.tpch import table

# ------------------------------------------------------------------ cleaners over whole tables


def part_keys(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("route_id"))


def order_keys(spark, sf, name: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias(name))


def doc_keys(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("booking_id"))


def region_names(spark, sf) -> DataFrame:
    return table(spark, sf, "region").select(F.initcap("r_name").alias("name"))


CLEANERS = {
    "Region": lambda s, d: cleaning.clean_regions(messy.regions(s, d)),
    "Guide": lambda s, d: cleaning.clean_guides(messy.guides(s, d)),
    "Route": lambda s, d: cleaning.clean_routes(messy.routes(s, d)),
    "ScheduledTour": lambda s, d: cleaning.clean_scheduled_tours(messy.scheduled_tours(s, d), part_keys(s, d)),
    "Booking": lambda s, d: cleaning.clean_bookings(messy.bookings(s, d), order_keys(s, d, "tour_id")),
    "Payment": lambda s, d: cleaning.clean_payments(messy.payments(s, d), doc_keys(s, d)),
    "Review": lambda s, d: cleaning.clean_reviews(
        messy.reviews(s, d), table(s, d, "labels").select(F.col("doc_id").alias("booking_id"))
    ),
    "Weather": lambda s, d: cleaning.clean_weather(messy.weather(s, d), region_names(s, d)),
    "BookingAttribution": lambda s, d: cleaning.clean_booking_attribution(
        messy.attribution(s, d), table(s, d, "customer").select(F.col("c_custkey").alias("booking_id"))
    ),
    "Marketing": lambda s, d: cleaning.clean_marketing(messy.marketing(s, d)),
    "WebsiteAnalytics": lambda s, d: cleaning.clean_website_analytics(messy.website(s, d)),
    "EquipmentHire": lambda s, d: cleaning.clean_equipment_hire(messy.equipment(s, d), doc_keys(s, d)),
}


def _money(*columns: str) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns) + ")"


# Per table: the raw CTE, the cleaned rows, and the (metric, value) pairs of the log.
REGION_TITLE = messy.INITCAP_REGION
SQL = {
    "Region": (
        f"raw AS ({messy.REGIONS}), c AS (SELECT DISTINCT region_id, {REGION_TITLE} AS name, replace(lower(r_name), ' ', '-') AS slug FROM raw)",
        "SELECT * FROM c",
        {"completeness": "1.0"},
    ),
    "Guide": (
        f"""one AS ({messy.GUIDES}), raw AS (SELECT * FROM one UNION ALL SELECT * FROM one), c AS (SELECT guide_id, 'O''Neil-Smith' AS first_name,
        last_name_raw, qualifications_raw AS qualifications, years_experience, 'English; Welsh' AS languages,
        ['employed','freelance','volunteer'][e + 1] AS employment_type, CAST(rate AS DOUBLE) AS day_rate_gbp, {REGION_TITLE} AS primary_region, active,
        tendency AS discount_tendency_pct, e FROM one)""",
        """SELECT guide_id, first_name, upper(trim(last_name_raw)[1]) || lower(trim(last_name_raw)[2:]) AS last_name, qualifications, years_experience,
        languages, employment_type, day_rate_gbp, primary_region, active, discount_tendency_pct FROM c""",
        {
            "completeness": "1.0",
            "missing_qualifications": "(SELECT count(*) FROM c WHERE qualifications IS NULL)",
            "currency_strings_parsed": "(SELECT count(*) FROM c WHERE e < 2)",
        },
    ),
    "Route": (
        f"""raw AS ({messy.ROUTES}), c AS (SELECT *, coalesce(elevation, median(elevation) OVER (PARTITION BY difficulty)) AS filled FROM raw)""",
        """SELECT route_id, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' Jack''S Rake' AS name, 'Peak District' AS region,
        difficulty, CASE WHEN v < 2 THEN p_size + 0.5::DOUBLE END AS distance_km, p_size / 4 AS duration_hours, p_size * 20 AS mountain_height_m,
        CAST(trunc(filled) AS INTEGER) AS elevation_gain_m, p_size > 40 AS is_featured, p_size > 5 AS active, lat AS trailhead_lat, lon AS trailhead_lon FROM c""",
        {
            "completeness": "1.0",
            "invalid_difficulty_values": "(SELECT count(*) FROM c WHERE difficulty = 'extreme')",
            "distance_unit_strings_parsed": "(SELECT count(*) FROM c WHERE v = 0)",
            "elevation_gain_imputed": "(SELECT count(*) FROM c WHERE elevation IS NULL)",
            "coordinates_outside_uk_bounds": "(SELECT count(*) FROM c WHERE NOT (lat BETWEEN 49.5 AND 61 AND lon BETWEEN -8.5 AND 2))",
        },
    ),
    "ScheduledTour": (
        f"raw AS ({messy.TOURS}), c AS (SELECT * FROM raw)",
        f"SELECT {_money('price_pp')} FROM c",
        {
            "completeness": "1.0",
            "invalid_price_rows": "(SELECT count(*) FROM c WHERE price_pp <= 0)",
            "orphan_route_references": "(SELECT count(*) FROM c WHERE route_id NOT IN (SELECT p_partkey FROM part))",
        },
    ),
    "Booking": (
        f"raw AS ({messy.BOOKINGS}), c AS (SELECT * FROM raw WHERE rn = 1)",
        "SELECT * EXCLUDE (rn, repaired, expected) REPLACE (CAST(list_price AS DOUBLE) AS list_price, CAST(total_price AS DOUBLE) AS total_price) FROM c",
        {
            "completeness": "(SELECT round((2 * count(*) + count(contact_email))::DOUBLE / (3 * count(*)), 4) FROM c)",
            "duplicate_booking_references_removed": "(SELECT count(*) FROM raw WHERE rn > 1)",
            "malformed_emails_repaired": "(SELECT count(*) FROM c WHERE repaired)",
            "malformed_emails_unrepaired": "(SELECT count(*) FROM c WHERE contact_email_invalid)",
            "inconsistent_discount_flag": "(SELECT count(*) FROM c WHERE discount_applied AND discount_pct <= 0)",
            "total_price_discount_mismatch": "(SELECT count(*) FROM c WHERE abs(total_price - expected) > 0.02)",
            "party_size_out_of_range": "(SELECT count(*) FROM c WHERE party_size NOT BETWEEN 1 AND 3)",
            "orphan_tour_references": "(SELECT count(*) FROM c WHERE tour_id NOT IN (SELECT o_orderkey FROM orders))",
        },
    ),
    "Payment": (
        f"raw AS ({messy.PAYMENTS}), c AS (SELECT * FROM raw WHERE rn = 1)",
        "SELECT * EXCLUDE (rn, user_id) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM c",
        {
            "completeness": "1.0",
            "duplicates_removed": "(SELECT count(*) FROM raw WHERE rn > 1)",
            "currency_casing_fixed": "(SELECT count(*) FROM c WHERE user_id % 4 IN (0, 2))",
            "orphan_booking_references": "(SELECT count(*) FROM c WHERE booking_id NOT IN (SELECT doc_id FROM documents))",
        },
    ),
    "Review": (
        f"raw AS ({messy.REVIEWS}), c AS (SELECT * FROM raw WHERE rn = 1)",
        "SELECT * EXCLUDE (rn) FROM c",
        {
            "completeness": """(SELECT round((count(overall_rating) + count(guide_rating) + count(route_rating) + count(safety_rating)
                + count(value_rating))::DOUBLE / (5 * count(*)), 4) FROM c)""",
            "duplicates_removed": "(SELECT count(*) FROM raw WHERE rn > 1)",
            **{
                f"missing_{r}": f"(SELECT count(*) FROM c WHERE {r} IS NULL)"
                for r in ("overall_rating", "guide_rating", "route_rating", "safety_rating", "value_rating")
            },
            "ratings_out_of_range": "(SELECT count(*) FROM c WHERE overall_rating NOT BETWEEN 1 AND 5 OR guide_rating NOT BETWEEN 1 AND 5)",
            "orphan_booking_references": "(SELECT count(*) FROM c WHERE booking_id NOT IN (SELECT doc_id FROM labels))",
        },
    ),
    "Weather": (
        f"raw AS ({messy.WEATHER}), c AS (SELECT * FROM raw WHERE rn = 1)",
        "SELECT * EXCLUDE (rn) FROM c",
        {
            "completeness": "1.0",
            "duplicates_removed": "(SELECT count(*) FROM raw WHERE rn > 1)",
            "unrecognised_region": "(SELECT count(*) FROM c WHERE region = 'Atlantis')",
            "negative_rain_values": "(SELECT count(*) FROM c WHERE rain_mm < 0)",
        },
    ),
    "BookingAttribution": (
        f"raw AS ({messy.ATTRIBUTION}), c AS (SELECT * FROM raw WHERE rn = 1)",
        "SELECT * EXCLUDE (rn) FROM c",
        {
            "completeness": "1.0",
            "duplicates_removed": "(SELECT count(*) FROM raw WHERE rn > 1)",
            "invalid_channel_values": "(SELECT count(*) FROM c WHERE channel = 'billboard')",
            "orphan_booking_references": "(SELECT count(*) FROM c WHERE booking_id NOT IN (SELECT c_custkey FROM customer))",
        },
    ),
    "Marketing": (
        f"raw AS ({messy.MARKETING}), c AS (SELECT * FROM raw)",
        f"SELECT {_money('spend')} FROM c",
        {"completeness": "1.0", "negative_spend_rows": "(SELECT count(*) FROM c WHERE spend < 0)"},
    ),
    "WebsiteAnalytics": (
        f"raw AS ({messy.WEBSITE}), c AS (SELECT * FROM raw)",
        "SELECT * EXCLUDE (country_raw, event_id) FROM c",
        {
            "completeness": "(SELECT round((2 * count(*) + count(country))::DOUBLE / (3 * count(*)), 4) FROM c)",
            "country_unrecognised_variant": "(SELECT count(*) FROM c WHERE event_id % 20 >= 18)",
            "country_names_standardised": "(SELECT count(*) FROM c WHERE trim(country_raw) IS DISTINCT FROM country OR country IS NULL)",
            "invalid_device_values": "(SELECT count(*) FROM c WHERE device = 'watch')",
        },
    ),
    "EquipmentHire": (
        f"raw AS ({messy.EQUIPMENT}), c AS (SELECT * FROM raw WHERE rn = 1)",
        f"SELECT * EXCLUDE (rn) REPLACE (CAST(hire_revenue AS DOUBLE) AS hire_revenue) FROM c",
        {
            "completeness": """(SELECT round((count(boots) + count(waterproofs) + count(poles) + count(helmet) + count(ice_axe) + count(crampons)
                + count(hire_revenue))::DOUBLE / (7 * count(*)), 4) FROM c)""",
            "duplicates_removed": "(SELECT count(*) FROM raw WHERE rn > 1)",
            "negative_revenue_rows": "(SELECT count(*) FROM c WHERE hire_revenue < 0)",
            "orphan_booking_references": "(SELECT count(*) FROM c WHERE booking_id NOT IN (SELECT doc_id FROM documents))",
        },
    ),
}
DEDUPED_PLAIN = ("Region", "Guide")  # the SQL removes their copies without row numbers


# What the log says about a metric.
NOTES = {
    "missing_qualifications": "kept empty, not imputed",
    "elevation_gain_imputed": "median elevation gain of the difficulty",
    "malformed_emails_repaired": "spelled-out 'at' replaced by '@'",
    "malformed_emails_unrepaired": "see contact_email_invalid",
    "country_names_standardised": "spelling variants mapped to one name",
    **{
        f"missing_{r}": "kept empty: a 1-5 scale is not imputed"
        for r in ("overall_rating", "guide_rating", "route_rating", "safety_rating", "value_rating")
    },
}


def log_sql(name: str, overrides: dict[str, str] | None = None) -> str:
    """Log entries of a table: counts, issues and their notes."""
    ctes, _, metrics = SQL[name]
    metrics = dict(metrics)
    if name in DEDUPED_PLAIN:
        metrics["duplicates_removed"] = "(SELECT count(*) FROM raw) - (SELECT count(*) FROM c)"
    metrics |= overrides or {}
    rows = ["SELECT 'row_count' AS metric, 'raw' AS stage, CAST((SELECT count(*) FROM raw) AS DOUBLE) AS value, '' AS notes",
            "SELECT 'row_count', 'cleaned', CAST((SELECT count(*) FROM c) AS DOUBLE), ''"]
    rows += [f"SELECT '{m}', 'cleaning', CAST({v} AS DOUBLE), {quoted(NOTES.get(m, ''))}" for m, v in metrics.items()]
    body = " UNION ALL ".join(rows)
    return f"""WITH {ctes} SELECT '{name}' AS "table", * FROM ({body}) WHERE value > 0 OR metric IN ('row_count', 'completeness')"""


def rule_sql(column: str, label: str) -> str:
    """When a check of a contract fails, by its label."""
    kind, _, rest = label.removesuffix(")").partition("(")
    values = rest.split(", ")
    return {
        "isin": lambda: f"{column} NOT IN ({', '.join(map(quoted, values))})",
        "between": lambda: f"{column} NOT BETWEEN {values[0]} AND {values[1]}",
        "above": lambda: f"{column} <= {values[0]}",
        "at_least": lambda: f"{column} < {values[0]}",
    }[kind]()


def failures_sql(name: str) -> str:
    """The ``validation_failures`` entry: failed rules over the cleaned rows, and rows that share a unique key."""
    ctes, rows, _ = SQL[name]
    contract = CLEAN[name]
    failed = [f"{c} IS NULL" for c, f in contract.fields.items() if not f.nullable]
    failed += [rule_sql(c, check.label) for c, f in contract.fields.items() for check in f.checks]
    counts = [f"(SELECT count(*) FILTER (WHERE {f}) FROM k)" for f in failed]
    for key in contract.keys:
        present = " AND ".join(f"{c} IS NOT NULL" for c in key)
        counts.append(
            f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM k WHERE {present} GROUP BY {', '.join(key)} HAVING count(*) > 1))"
        )
    return f"""WITH {ctes}, k AS ({rows}) SELECT '{name}' AS "table", 'validation_failures' AS metric, 'cleaning' AS stage,
        CAST({" + ".join(counts)} AS DOUBLE) AS value, '' AS notes"""


def run_sql(names, overrides: dict[str, dict[str, str]] | None = None) -> str:
    """The whole log of a run over several tables."""
    parts = [(log_sql(n, (overrides or {}).get(n)), failures_sql(n)) for n in names]
    return " UNION ALL ".join(f"SELECT * FROM ({sql})" for pair in parts for sql in pair)


ENTRY = ["table", "metric", "stage", "value", "notes"]


def _register(position: int, name: str) -> None:
    key = f"c{position:02d}_clean_" + "".join("_" + c.lower() if c.isupper() else c for c in name).lstrip("_")

    @query(key, f"WITH {SQL[name][0]} {SQL[name][1]}")
    def rows(spark, sf):
        return CLEANERS[name](spark, sf).rows

    @query(f"{key}_log", log_sql(name))
    def log(spark, sf):
        return CLEANERS[name](spark, sf).quality().select(*ENTRY)


for _position, _name in enumerate(CLEANERS, start=1):
    _register(_position, _name)


@query(
    "c00_dedupe_keep_first",
    """SELECT booking_id, channel, copies FROM (SELECT o_custkey AS booking_id, o_orderpriority AS channel, count(*) OVER (PARTITION BY o_custkey) AS copies,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def c00(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("booking_id"), F.col("o_orderpriority").alias("channel"), "o_orderdate", "o_orderkey"
    )
    first = dedupe.keep_first(rows, ["booking_id"], ["o_orderdate", "o_orderkey"])
    return first.select("booking_id", "channel", F.col(dedupe.COPIES).alias("copies"))


def full_log(spark, sf, names, started=None) -> DataFrame:
    """Cleaning log and validation failures of several tables; each table goes once its entries are stored."""
    parts = []
    for name in names:
        cleaned = CLEANERS[name](spark, sf)
        path = shared_path(spark, name)
        files.write_table(cleaned.frame, path)
        stored = spark.read.parquet(path)
        counts = validation.validate(stored, CLEAN[name])
        entries = cleaned.quality(stored, started).unionByName(quality.failures_row(counts, name, started))
        parts.append(written(entries, "log-entries"))
        removed(spark, path)
    return reduce(DataFrame.unionByName, parts)


RAW_TABLES = {
    "regions": messy.regions,
    "guides": messy.guides,
    "routes": messy.routes,
    "scheduled_tours": messy.scheduled_tours,
    "bookings": messy.bookings,
    "payments": messy.payments,
    "reviews": messy.reviews,
    "weather": messy.weather,
    "booking_attribution": messy.attribution,
    "marketing": messy.marketing,
    "website_analytics": messy.website,
    "equipment_hire": messy.equipment,
}


#: Their lines are put in order before they become wide.
ORDERED_TABLES = {"bookings": messy.bookings, "weather": messy.weather}


def raw_files(spark, sf, names) -> str:
    """Raw CSV folders of several compressed files each, their lines in the order of the ordinal."""
    folder = shared_path(spark, "raw")
    for name in names:
        if name in ORDERED_TABLES:
            raw = ORDERED_TABLES[name](spark, sf, ordered=True)
        else:
            raw = RAW_TABLES[name](spark, sf)
            raw = messy.in_order(raw, ORDINAL) if ORDINAL in raw.columns else raw
        columns = [f.split()[0] for f in RAW[name].split(", ")]
        files.write_csv(raw.select(*columns), f"{folder}/{name}_raw.csv", compression="gzip")
    return folder


BOOKED = "(SELECT count(*) FROM c WHERE booking_id NOT IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem))"
#: In a run the bookings looked up are the cleaned ones.
OF_BOOKINGS = {n: {"orphan_booking_references": BOOKED} for n in ("Payment", "Review", "BookingAttribution", "EquipmentHire")}


@query("c13_core_cleaning_run", run_sql(pipeline.CORE, OF_BOOKINGS))
def c13(spark, sf):
    """The core job over raw files; its log as the ledger says it is complete."""
    raw = raw_files(spark, sf, [pipeline.ENTITIES[n].raw for n in pipeline.CORE])
    log = shared_path(spark, "quality-log")
    pipeline.run_core(spark, raw, shared_path(spark, "clean"), log)
    return quality.read_log(spark, log).select(*ENTRY)


@query("c14_extension_cleaning_run", run_sql(pipeline.EXTENSIONS, OF_BOOKINGS))
def c14(spark, sf):
    """The extension job over raw files, after an earlier job has stored its parents."""
    raw = raw_files(spark, sf, [pipeline.ENTITIES[n].raw for n in pipeline.EXTENSIONS])
    clean, log = shared_path(spark, "clean"), shared_path(spark, "quality-log")
    for parent in ("Region", "Booking"):
        files.write_table(CLEANERS[parent](spark, sf).frame, f"{clean}/{parent}")
    pipeline.run_extensions(spark, raw, clean, log)
    return quality.read_log(spark, log).select(*ENTRY)


# ------------------------------------------------------------------ validation

LINES = Contract(
    {
        "l_orderkey": Field("BIGINT"),
        "l_quantity": Field("DOUBLE", (between(1, 45),)),
        "l_discount": Field("DOUBLE", (between(0, 0.08),)),
        "l_tax": Field("DOUBLE", (above(0),)),
        "l_returnflag": Field("STRING", (one_of(("A", "N")),)),
    },
    unique=(("l_orderkey", "l_linenumber"),),
)


@query(
    "v01_schema_contract",
    """SELECT 'o_comment' AS "column", 'string' AS expected, 'missing' AS found, count(*) AS rows FROM orders
    UNION ALL SELECT 'o_orderkey', 'int', 'bigint', count(*) FROM orders""",
)
def v01(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    contract = Contract({"o_orderkey": Field("INT"), "o_totalprice": Field("DOUBLE"), "o_comment": Field("STRING")})
    gaps = [(c, e, f or "missing") for c, e, f in validation.schema_gaps(orders, contract)]
    found = spark.createDataFrame(gaps, "column STRING, expected STRING, found STRING")
    return found.withColumn("rows", orders.agg(count_rows()).scalar())


@query(
    "v02_not_null",
    """SELECT 'quality' AS "column", 'not_null' AS "check", count(*) FILTER (WHERE quality IS NULL) AS failures FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'doc_id', 'not_null', count(*) FILTER (WHERE doc_id IS NULL) FROM documents""",
)
def v02(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return validation.rule_counts(joined, Contract({"doc_id": Field("BIGINT"), "quality": Field("INT")}))


@query(
    "v03_unique_key",
    """SELECT 'o_custkey,o_orderdate' AS "column", 'unique' AS "check", CAST(coalesce(sum(n), 0) AS BIGINT) AS failures FROM
    (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)""",
)
def v03(spark, sf):
    return validation.duplicate_count(table(spark, sf, "orders"), ("o_custkey", "o_orderdate"))


@query(
    "v04_closed_enum",
    """SELECT 'c_mktsegment' AS "column", 'isin(BUILDING, MACHINERY)' AS "check", count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING','MACHINERY')) AS failures FROM customer""",
)
def v04(spark, sf):
    contract = Contract({"c_mktsegment": Field("STRING", (one_of(("BUILDING", "MACHINERY")),), nullable=True)})
    return validation.rule_counts(table(spark, sf, "customer"), contract)


@query(
    "v05_inclusive_range",
    """SELECT 'p_size' AS "column", 'between(5, 45)' AS "check", count(*) FILTER (WHERE p_size < 5 OR p_size > 45) AS failures FROM part""",
)
def v05(spark, sf):
    contract = Contract({"p_size": Field("INT", (between(5, 45),), nullable=True)})
    return validation.rule_counts(table(spark, sf, "part"), contract)


@query(
    "v06_positive_values",
    """SELECT 's_acctbal' AS "column", 'above(0)' AS "check", count(*) FILTER (WHERE s_acctbal <= 0) AS failures FROM supplier""",
)
def v06(spark, sf):
    contract = Contract({"s_acctbal": Field("DOUBLE", (above(0),), nullable=True)})
    return validation.rule_counts(table(spark, sf, "supplier"), contract)


LINE_FAILURES = """SELECT 'l_quantity' AS "column", 'between(1, 45)' AS "check", CAST(l_quantity AS VARCHAR) AS value, count(*) AS rows FROM lineitem WHERE l_quantity > 45 GROUP BY 3
    UNION ALL SELECT 'l_discount', 'between(0, 0.08)', CAST(l_discount AS VARCHAR), count(*) FROM lineitem WHERE l_discount > 0.08 GROUP BY 3
    UNION ALL SELECT 'l_tax', 'above(0)', CAST(l_tax AS VARCHAR), count(*) FROM lineitem WHERE l_tax <= 0 GROUP BY 3
    UNION ALL SELECT 'l_returnflag', 'isin(A, N)', l_returnflag, count(*) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 3
    UNION ALL SELECT 'l_orderkey,l_linenumber', 'unique', l_orderkey || ',' || l_linenumber, count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


@query("v07_failure_cases", LINE_FAILURES)
def v07(spark, sf):
    return validation.failure_cases(table(spark, sf, "lineitem"), LINES)


@query(
    "v07_failure_counts",
    f"""SELECT k."column", k."check", CAST(coalesce(sum(rows), 0) AS BIGINT) AS failures FROM (VALUES ('l_orderkey','not_null'),('l_quantity','not_null'),('l_quantity','between(1, 45)'),
    ('l_discount','not_null'),('l_discount','between(0, 0.08)'),('l_tax','not_null'),('l_tax','above(0)'),('l_returnflag','not_null'),('l_returnflag','isin(A, N)'),
    ('l_orderkey,l_linenumber','unique')) k("column", "check") LEFT JOIN ({LINE_FAILURES}) f ON f."column" = k."column" AND f."check" = k."check" GROUP BY 1, 2""",
)
def v07_counts(spark, sf):
    return validation.validate(table(spark, sf, "lineitem"), LINES)


REFERENCES = {
    "Lines": Contract(
        {}, references={"l_orderkey": ("Orders", "o_orderkey"), "l_partkey": ("Documents", "doc_id"), "l_suppkey": ("Suppliers", "s_suppkey")}
    )
}


@query(
    "v08_foreign_keys",
    """SELECT 'Lines' AS "table", 'l_orderkey' AS "column", count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS failures FROM lineitem
    UNION ALL SELECT 'Lines', 'l_partkey', count(*) FILTER (WHERE l_partkey NOT IN (SELECT doc_id FROM documents)) FROM lineitem
    UNION ALL SELECT 'Lines', 'l_suppkey', count(*) FILTER (WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) FROM lineitem""",
)
def v08(spark, sf):
    tables = {
        "Lines": table(spark, sf, "lineitem"),
        "Orders": table(spark, sf, "orders"),
        "Documents": table(spark, sf, "documents"),
        "Suppliers": table(spark, sf, "supplier"),
    }
    return validation.reference_counts(tables, REFERENCES, "Lines")


@query(
    "v09_check_constraints",
    over(
        "lines_fact",
        """SELECT 'season' AS "column", 'isin(winter, summer)' AS "check", count(*) FILTER (WHERE season NOT IN ('winter','summer')) AS failures FROM lines_fact
        UNION ALL SELECT 'status', 'isin(pending, confirmed, cancelled, amended)', count(*) FILTER (WHERE status NOT IN ('pending','confirmed','cancelled','amended')) FROM lines_fact
        UNION ALL SELECT 'party_size', 'between(1, 3)', count(*) FILTER (WHERE party_size NOT BETWEEN 1 AND 3) FROM lines_fact""",
    ),
)
def v09(spark, sf):
    fields = STAR["FactBookings"].fields
    contract = Contract({c: Field(fields[c].type, fields[c].checks, nullable=True) for c in ("season", "status", "party_size")})
    return validation.rule_counts(tpch.line_bookings(spark, sf, region=False), contract)


@query(
    "v10_composite_unique",
    over(
        "weather",
        """SELECT 'date_id,region_id' AS "column", 'unique' AS "check", CAST(coalesce(sum(n), 0) AS BIGINT) AS failures
        FROM (SELECT count(*) AS n FROM weather GROUP BY d, region_id HAVING count(*) > 1)
        UNION ALL SELECT 'l_shipdate,l_suppkey', 'unique', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_shipdate, l_suppkey HAVING count(*) > 1)""",
    ),
)
def v10(spark, sf):
    daily = validation.duplicate_count(tpch.weather(spark, sf), STAR["FactWeather"].unique[0])
    return daily.unionByName(validation.duplicate_count(table(spark, sf, "lineitem"), ("l_shipdate", "l_suppkey")))


@query(
    "v11_warehouse_invariants",
    over(
        "lines_fact reviews",
        """SELECT 'party_size_1_to_3' AS rule, count(*) FILTER (WHERE party_size NOT BETWEEN 1 AND 3) AS violations FROM lines_fact
        UNION ALL SELECT 'total_within_list_price', count(*) FILTER (WHERE total_price > list_price + 1.5) FROM lines_fact
        UNION ALL SELECT 'undiscounted_has_no_pct', count(*) FILTER (WHERE NOT discount_applied AND discount_pct <> 0) FROM lines_fact
        UNION ALL SELECT 'rating_1_to_5', count(*) FILTER (WHERE overall_rating NOT BETWEEN 1 AND 5) FROM reviews""",
    ),
)
def v11(spark, sf):
    return validation.invariants(tpch.line_bookings(spark, sf, region=False), tpch.reviews(spark, sf))


@query(
    "v12_view_reconciles_with_fact",
    """SELECT t AS left_total, t AS right_total, 0.0::DOUBLE AS difference FROM (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t FROM orders WHERE o_orderstatus = 'F')""",
)
def v12(spark, sf):
    star = tpch.order_star(spark, sf, region=False)
    confirmed = star["FactBookings"].where("status = 'confirmed'")
    return validation.reconcile(reports.monthly_revenue(star), "revenue", confirmed, "total_price")


@query(
    "v13_marketing_reconciles_with_bookings",
    over(
        "marketing",
        """SELECT CAST((SELECT sum(conversions) FROM marketing) AS BIGINT) AS left_total, (SELECT count(*) FROM orders WHERE o_orderstatus IN ('F','O')) AS right_total,
        CAST((SELECT sum(conversions) FROM marketing) AS BIGINT) - (SELECT count(*) FROM orders WHERE o_orderstatus IN ('F','O')) AS difference""",
    ),
)
def v13(spark, sf):
    trips = tpch.order_bookings(spark, sf, region=False).where(F.col("status").isin("confirmed", "amended"))
    return validation.reconcile(tpch.marketing(spark, sf), "conversions", trips.agg(count_rows().alias("n")), "n")


# ------------------------------------------------------------------ quality log


@query(
    "q01_row_count_entries",
    """SELECT 'Orders' AS "table", 'row_count' AS metric, 'raw' AS stage, CAST(count(*) AS DOUBLE) AS value FROM orders
    UNION ALL SELECT 'Events', 'row_count', 'cleaned', CAST(count(*) AS DOUBLE) FROM events""",
)
def q01(spark, sf):
    entries = quality.row_count_entry(table(spark, sf, "orders"), "Orders", "raw").unionByName(
        quality.row_count_entry(table(spark, sf, "events"), "Events", "cleaned")
    )
    return entries.select("table", "metric", "stage", "value")


@query(
    "q02_metric_entries",
    """SELECT 'Supplier' AS "table", 'negative_balance' AS metric, 'cleaning' AS stage, CAST(count(*) FILTER (WHERE s_acctbal < 0) AS DOUBLE) AS value FROM supplier""",
)
def q02(spark, sf):
    one = table(spark, sf, "supplier").agg(F.count_if(F.col("s_acctbal") < 0).alias("n"))
    return quality.metric_entry(one, "Supplier", "negative_balance", "n").select("table", "metric", "stage", "value")


@query(
    "q03_stamped_log",
    f"""SELECT TIMESTAMP '2024-01-01 06:00:00' AS run_started_at, * FROM ({log_sql("Weather")})""",
)
def q03(spark, sf):
    log = CLEANERS["Weather"](spark, sf).quality(started=datetime(2024, 1, 1, 6))
    return log.select(F.col("run_started_at").cast("timestamp_ntz").alias("run_started_at"), *ENTRY)


# Of two runs of the core tables the first saw three times as much; the extension tables were stored by the first only.
EVERY = (*pipeline.CORE, *pipeline.EXTENSIONS)
FIRST_RUN, SECOND_RUN = "a1", "b2"
EARLIER = datetime(2024, 1, 1, 6)


STORED_LOGS: dict[tuple[str, str], str] = {}


def two_runs(spark, sf) -> str:
    """A stored log: a run over all tables, with other figures for the core, and a newer one over the core alone.

    Queries of one session over the same tables share it.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in STORED_LOGS:
        return STORED_LOGS[key]
    now = full_log(spark, sf, EVERY, EARLIER)
    path = shared_path(spark, "quality-log")
    core = F.col("table").isin(*pipeline.CORE)
    first = now.withColumn("value", F.when(core, F.col("value") * 3).otherwise(F.col("value")))
    files.append_log(first, path, FIRST_RUN)
    second = now.where(core).withColumn("run_started_at", F.col("run_started_at") + F.expr("INTERVAL 1 DAY"))
    files.append_log(second, path, SECOND_RUN)
    STORED_LOGS[key] = path
    return path


@query(
    "q04_stage_summary",
    f"""SELECT "table", max(value) FILTER (WHERE stage = 'raw') AS raw, max(value) FILTER (WHERE stage = 'cleaned') AS cleaned
    FROM ({run_sql(EVERY)}) WHERE metric = 'row_count' GROUP BY 1""",
)
def q04(spark, sf):
    return quality.stage_summary(spark.read.parquet(two_runs(spark, sf)))


@query(
    "q04_metric_summary",
    f"""SELECT "table", metric, value, notes FROM ({run_sql(EVERY)}) WHERE metric <> 'row_count'""",
)
def q04_metrics(spark, sf):
    return quality.metric_summary(spark.read.parquet(two_runs(spark, sf)))


@query(
    "s10_persisted_quality_log",
    f"""WITH log AS ({run_sql(EVERY)}), runs AS (
        SELECT *, '{FIRST_RUN}' AS run_id, TIMESTAMP '2024-01-01 06:00:00' AS run_started_at, CASE WHEN "table" IN {pipeline.CORE} THEN 3 ELSE 1 END AS times FROM log
        UNION ALL SELECT *, '{SECOND_RUN}', TIMESTAMP '2024-01-02 06:00:00', 1 FROM log WHERE "table" IN {pipeline.CORE}
    ) SELECT run_id, run_started_at, "table", metric, stage, value * times AS value, notes FROM runs""",
)
def s10(spark, sf):
    log = spark.read.parquet(two_runs(spark, sf))
    return log.select("run_id", F.col("run_started_at").cast("timestamp_ntz").alias("run_started_at"), *ENTRY)


@query(
    "m41_log_kpis",
    f"""SELECT avg(value) FILTER (WHERE metric = 'completeness') AS completeness_pct,
    sum(value) FILTER (WHERE metric = 'validation_failures') AS total_validation_failures,
    sum(value) FILTER (WHERE metric = 'duplicates_removed') AS total_duplicates_removed FROM ({run_sql(EVERY)})""",
)
def m41(spark, sf):
    return quality.log_kpis(spark.read.parquet(two_runs(spark, sf)))


@query(
    "m49_duplicate_and_failure_rates",
    f"""SELECT "table", coalesce(sum(value) FILTER (WHERE metric IN ('duplicates_removed', 'duplicate_booking_references_removed')), 0)
      / max(value) FILTER (WHERE metric = 'row_count' AND stage = 'raw') AS duplicate_rate,
    sum(value) FILTER (WHERE metric = 'validation_failures') / max(value) FILTER (WHERE metric = 'row_count' AND stage = 'cleaned') AS validation_failure_rate
    FROM ({run_sql(EVERY)}) GROUP BY 1""",
)
def m49(spark, sf):
    return quality.table_rates(spark.read.parquet(two_runs(spark, sf)))


@query(
    "m50_run_duration",
    """WITH runs AS (SELECT CAST(user_id AS VARCHAR) AS run_id, min(ts) AS first, max(ts) AS last, max(ts) FILTER (WHERE event_type = 'purchase') AS bought,
        max(ts) FILTER (WHERE event_type = 'error') AS broke, count(*) FILTER (WHERE event_type = 'view') AS tables FROM events GROUP BY 1)
    SELECT run_id, CASE WHEN bought IS NULL AND broke IS NULL THEN 'unfinished' WHEN broke IS NULL OR bought >= broke THEN 'finished' ELSE 'failed' END AS state,
    CASE WHEN bought IS NOT NULL OR broke IS NOT NULL THEN date_diff('microsecond', first, greatest(bought, broke)) / 1000000 END AS duration_seconds, tables FROM runs""",
)
def m50(spark, sf):
    """Users as runs: each event is one of the ledger's, the first starts the run as well."""
    seen = table(spark, sf, "events")
    at = F.col("ts").cast("timestamp").alias("at")
    run = [F.col("user_id").cast("string").alias("run_id"), F.lit("job").alias("job"), F.lit("t").alias("table")]
    kinds = {"purchase": ledger.FINISHED, "error": ledger.FAILED, "view": ledger.STORED}
    state = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    recorded = seen.select(*run, F.coalesce(state, F.lit(ledger.STARTED)).alias("state"), at)
    begun = seen.select(*run, F.lit(ledger.STARTED).alias("state"), at)
    return ledger.runs(recorded.unionByName(begun)).select("run_id", "state", "duration_seconds", "tables")
