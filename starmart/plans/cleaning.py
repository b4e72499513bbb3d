"""Cleaning of the twelve entities.

Each function takes the raw frame (and cleaned parents) and returns a
``Cleaned``. Only duplicates are dropped; every other problem is flagged,
counted and passed through. Raw frames carry an ingest ordinal in the order of
files and lines, so keeping the first duplicate does not depend on tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import dates, numbers, text
from starmart.operators.dedupe import COPIES, keep_first
from starmart.operators.lookup import flag_missing
from starmart.operators.median import group_median
from starmart.plans.quality import Cleaned
from starmart.schemas import (
    CHANNELS,
    CLEAN,
    DEVICES,
    DIFFICULTIES,
    EQUIPMENT,
    MAX_PARTY,
    RATINGS,
    UK_LATITUDE,
    UK_LONGITUDE,
)

ORDINAL = "_ordinal"


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _finish(
    name: str,
    df: DataFrame,
    rules: dict[str, Column],
    issues: dict[str, tuple[Column | None, str]],
    complete_over: list[str],
    removed_metric: str = "duplicates_removed",
) -> Cleaned:
    """Apply the column rules in one projection and keep the issue flags next to them.

    An issue whose condition is None already has its ``dq_`` column.
    """
    contract = CLEAN[name]
    columns = [rules.get(c, F.col(c)).cast(f.type).alias(c) for c, f in contract.fields.items()]
    flags = [
        F.col(f"dq_{m}") if condition is None else condition.alias(f"dq_{m}")
        for m, (condition, _) in issues.items()
    ]
    copies = [COPIES] if COPIES in df.columns else []
    return Cleaned(
        name,
        df.select(*columns, *flags, *copies),
        list(contract.fields),
        {m: note for m, (_, note) in issues.items()},
        complete_over,
        removed_metric,
    )


def clean_regions(raw: DataFrame) -> Cleaned:
    df = keep_first(raw, ["region_id"], ORDINAL)
    name = text.titled("region_name_raw")
    return _finish("Region", df, {"name": name, "slug": text.slug(name)}, {}, ["name", "slug"])


def clean_guides(raw: DataFrame) -> Cleaned:
    df = keep_first(raw, ["guide_id"], ORDINAL)
    return _finish(
        "Guide",
        df,
        {
            "first_name": text.titled("first_name_raw"),
            "last_name": text.titled("last_name_raw"),
            "qualifications": F.col("qualifications_raw"),
            "languages": F.col("languages_raw"),
            "employment_type": text.lowered("employment_type"),
            "day_rate_gbp": numbers.currency("day_rate_gbp_raw"),
            "primary_region": text.titled("primary_region_raw"),
        },
        {
            "missing_qualifications": (F.col("qualifications_raw").isNull(), "kept empty, not imputed"),
            "currency_strings_parsed": (numbers.has_currency_mark("day_rate_gbp_raw"), ""),
        },
        ["first_name", "last_name", "primary_region"],
    )


def clean_routes(raw: DataFrame) -> Cleaned:
    difficulty = text.lowered("difficulty_raw")
    df = keep_first(raw, ["route_id"], ORDINAL).withColumn("difficulty", difficulty)
    medians = group_median(df, ["difficulty"], "elevation_gain_m_raw", "_median").withColumnRenamed(
        "difficulty", "_difficulty"
    )
    df = df.join(medians, F.col("difficulty") == F.col("_difficulty"), "left")
    inside = F.col("trailhead_lat").between(*UK_LATITUDE) & F.col("trailhead_lon").between(*UK_LONGITUDE)
    return _finish(
        "Route",
        df,
        {
            "name": text.titled("route_name_raw"),
            "region": text.titled("region_name_raw"),
            "distance_km": numbers.distance_km("distance_km_raw"),
            "elevation_gain_m": numbers.whole(F.coalesce("elevation_gain_m_raw", "_median")),
        },
        {
            "invalid_difficulty_values": (~_true(F.col("difficulty").isin(*DIFFICULTIES)), ""),
            "distance_unit_strings_parsed": (numbers.has_distance_unit("distance_km_raw"), ""),
            "elevation_gain_imputed": (
                F.col("elevation_gain_m_raw").isNull(),
                "median elevation gain of the difficulty",
            ),
            "coordinates_outside_uk_bounds": (~_true(inside), ""),
        },
        ["name", "region", "difficulty"],
    )


def clean_scheduled_tours(raw: DataFrame, routes: DataFrame) -> Cleaned:
    df = keep_first(raw, ["tour_id"], ORDINAL)
    df = flag_missing(df, "route_id", routes, "route_id", "dq_orphan_route_references", raw)
    price = numbers.currency("price_pp_raw")
    return _finish(
        "ScheduledTour",
        df,
        {
            "season": text.lowered("season"),
            "start_time": text.stripped("start_time_raw"),
            "price_pp": price,
            "status": text.lowered("status_raw"),
        },
        {
            "invalid_price_rows": (_true(price <= 0), ""),
            "orphan_route_references": (None, ""),
        },
        ["date", "season", "status"],
    )


def clean_bookings(raw: DataFrame, tours: DataFrame) -> Cleaned:
    df = keep_first(raw, ["booking_reference"], ORDINAL)
    df = flag_missing(df, "tour_id", tours, "tour_id", "dq_orphan_tour_references", raw)
    address, invalid = text.email("contact_email_raw")
    list_price, total = numbers.currency("list_price_raw"), numbers.currency("total_price_raw")
    discount = F.col("discount_pct").cast("decimal(9,4)")
    expected = list_price * (F.lit(1).cast("decimal(9,4)") - discount)
    spelled = F.contains("contact_email_raw", F.lit(text.SPELLED_AT))
    return _finish(
        "Booking",
        df,
        {
            "contact_name": text.titled("contact_name_raw"),
            "contact_email": address,
            "contact_email_invalid": invalid,
            "contact_phone": text.stripped("contact_phone_raw"),
            "emergency_contact": text.titled("emergency_contact_raw"),
            "notes": F.col("notes_raw"),
            "status": text.lowered("status_raw"),
            "list_price": list_price,
            "total_price": total,
            "created_at": dates.tolerant_timestamp("created_at"),
            "archived_at": dates.tolerant_timestamp("archived_at"),
        },
        {
            "malformed_emails_repaired": (_true(spelled & ~invalid), "spelled-out 'at' replaced by '@'"),
            "malformed_emails_unrepaired": (invalid, "see contact_email_invalid"),
            "inconsistent_discount_flag": (_true(F.col("discount_applied") & (F.col("discount_pct") <= 0)), ""),
            "total_price_discount_mismatch": (_true(numbers.differs(total, expected)), ""),
            "party_size_out_of_range": (~_true(F.col("party_size").between(1, MAX_PARTY)), ""),
            "orphan_tour_references": (None, ""),
        },
        ["contact_name", "contact_email", "status"],
        "duplicate_booking_references_removed",
    )


def clean_payments(raw: DataFrame, bookings: DataFrame) -> Cleaned:
    df = keep_first(raw, ["payment_id"], ORDINAL)
    df = flag_missing(df, "booking_id", bookings, "booking_id", "dq_orphan_booking_references", raw)
    return _finish(
        "Payment",
        df,
        {
            "currency": text.uppered("currency_raw"),
            "amount": numbers.currency("amount_raw"),
            "status": text.lowered("status_raw"),
            "paid_at": dates.tolerant_timestamp("paid_at"),
            "refunded_at": dates.tolerant_timestamp("refunded_at"),
        },
        {
            "currency_casing_fixed": (_true(text.stripped("currency_raw") == "gbp"), ""),
            "orphan_booking_references": (None, ""),
        },
        ["amount", "currency", "status"],
    )


def clean_reviews(raw: DataFrame, bookings: DataFrame) -> Cleaned:
    df = keep_first(raw, ["booking_id"], ORDINAL)
    df = flag_missing(df, "booking_id", bookings, "booking_id", "dq_orphan_booking_references", raw)
    out_of_range = F.lit(False)
    for r in RATINGS:
        out_of_range = out_of_range | _true(~F.col(r).between(1, 5))
    missing = {f"missing_{r}": (F.col(r).isNull(), "kept empty: a 1-5 scale is not imputed") for r in RATINGS}
    return _finish(
        "Review",
        df,
        {"would_recommend": numbers.yes_no("would_recommend_raw")},
        {**missing, "ratings_out_of_range": (out_of_range, ""), "orphan_booking_references": (None, "")},
        list(RATINGS),
    )


def clean_weather(raw: DataFrame, regions: DataFrame) -> Cleaned:
    named = raw.withColumn("region", text.titled("region_raw"))
    df = keep_first(named, ["date", "region"], ORDINAL)
    df = flag_missing(df, "region", regions, "name", "dq_unrecognised_region")
    return _finish(
        "Weather",
        df,
        {},
        {
            "unrecognised_region": (None, ""),
            "negative_rain_values": (_true(F.col("rain_mm") < 0), ""),
        },
        ["date", "region", "temperature_c"],
    )


def clean_booking_attribution(raw: DataFrame, bookings: DataFrame) -> Cleaned:
    df = keep_first(raw, ["booking_id"], ORDINAL)
    df = flag_missing(df, "booking_id", bookings, "booking_id", "dq_orphan_booking_references", raw)
    channel = text.lowered("channel_raw")
    return _finish(
        "BookingAttribution",
        df,
        {"channel": channel},
        {
            "invalid_channel_values": (~_true(channel.isin(*CHANNELS)), ""),
            "orphan_booking_references": (None, ""),
        },
        ["channel"],
    )


def clean_marketing(raw: DataFrame) -> Cleaned:
    spend = numbers.currency("spend_raw")
    return _finish(
        "Marketing",
        raw,
        {
            "campaign": text.titled("campaign_raw"),
            "channel": text.lowered("channel_raw"),
            "month": dates.month_start("year_month"),
            "spend": spend,
            "revenue": numbers.currency("revenue_raw"),
        },
        {"negative_spend_rows": (_true(spend < 0), "")},
        ["campaign", "channel", "month"],
    )


def clean_website_analytics(raw: DataFrame) -> Cleaned:
    country, unknown = text.country("country_raw")
    device = text.lowered("device_raw")
    changed = F.coalesce(text.stripped("country_raw") != country, F.lit(True))
    return _finish(
        "WebsiteAnalytics",
        raw,
        {
            "traffic_source": text.lowered("traffic_source_raw"),
            "device": device,
            "bounce_rate": numbers.clipped("bounce_rate"),
            "conversion_rate": numbers.clipped("conversion_rate"),
            "country": country,
        },
        {
            "country_unrecognised_variant": (unknown, ""),
            "country_names_standardised": (changed, "spelling variants mapped to one name"),
            "invalid_device_values": (~_true(device.isin(*DEVICES)), ""),
        },
        ["traffic_source", "device", "country"],
    )


def clean_equipment_hire(raw: DataFrame, bookings: DataFrame) -> Cleaned:
    df = keep_first(raw, ["booking_id"], ORDINAL)
    df = flag_missing(df, "booking_id", bookings, "booking_id", "dq_orphan_booking_references", raw)
    revenue = numbers.currency("hire_revenue_raw")
    return _finish(
        "EquipmentHire",
        df,
        {**{item: numbers.yes_no(f"{item}_raw") for item in EQUIPMENT}, "hire_revenue": revenue},
        {
            "negative_revenue_rows": (_true(revenue < 0), ""),
            "orphan_booking_references": (None, ""),
        },
        [*EQUIPMENT, "hire_revenue"],
    )
