"""Raw, cleaned and star-schema table definitions.

Raw columns that may hold messy text are strings. Money is DECIMAL(18,2).
Spark enforces no keys on files, so keys, enums and ranges are stated here as
data and counted by ``plans.validation``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

# ------------------------------------------------------------------ raw CSV

RAW = {
    "regions": "region_id BIGINT, region_name_raw STRING",
    "guides": (
        "guide_id BIGINT, first_name_raw STRING, last_name_raw STRING, qualifications_raw STRING, "
        "years_experience INT, languages_raw STRING, employment_type STRING, day_rate_gbp_raw STRING, "
        "primary_region_raw STRING, active BOOLEAN, discount_tendency_pct DOUBLE"
    ),
    "routes": (
        "route_id BIGINT, route_name_raw STRING, region_name_raw STRING, difficulty_raw STRING, "
        "distance_km_raw STRING, duration_hours DOUBLE, mountain_height_m INT, elevation_gain_m_raw DOUBLE, "
        "is_featured BOOLEAN, active BOOLEAN, trailhead_lat DOUBLE, trailhead_lon DOUBLE"
    ),
    "scheduled_tours": (
        "tour_id BIGINT, route_id BIGINT, guide_id DOUBLE, date DATE, season STRING, start_time_raw STRING, "
        "price_pp_raw STRING, max_group_size INT, status_raw STRING"
    ),
    "bookings": (
        "booking_id BIGINT, tour_id BIGINT, booking_reference STRING, party_size INT, contact_name_raw STRING, "
        "contact_email_raw STRING, contact_phone_raw STRING, emergency_contact_raw STRING, notes_raw STRING, "
        "status_raw STRING, list_price_raw STRING, discount_pct DOUBLE, discount_applied BOOLEAN, "
        "total_price_raw STRING, created_at STRING, archived_at STRING"
    ),
    "payments": (
        "payment_id BIGINT, booking_id BIGINT, stripe_payment_intent_id STRING, "
        "stripe_checkout_session_id STRING, stripe_refund_id STRING, amount_raw STRING, currency_raw STRING, "
        "status_raw STRING, paid_at STRING, refunded_at STRING"
    ),
    "reviews": (
        "booking_id BIGINT, overall_rating DOUBLE, guide_rating DOUBLE, route_rating DOUBLE, "
        "safety_rating DOUBLE, value_rating DOUBLE, comment_length INT, would_recommend_raw STRING"
    ),
    "weather": (
        "date DATE, region_raw STRING, temperature_c DOUBLE, rain_mm DOUBLE, wind_speed_kmh DOUBLE, "
        "visibility_km DOUBLE, snow_depth_cm DOUBLE, storm_warning BOOLEAN"
    ),
    "booking_attribution": "booking_id BIGINT, channel_raw STRING",
    "marketing": (
        "campaign_raw STRING, channel_raw STRING, year_month STRING, spend_raw STRING, clicks BIGINT, "
        "impressions BIGINT, conversions BIGINT, revenue_raw STRING"
    ),
    "website_analytics": (
        "week_starting DATE, traffic_source_raw STRING, device_raw STRING, sessions BIGINT, users BIGINT, "
        "bounce_rate DOUBLE, conversion_rate DOUBLE, browser STRING, country_raw STRING"
    ),
    "equipment_hire": (
        "booking_id BIGINT, boots_raw STRING, waterproofs_raw STRING, poles_raw STRING, helmet_raw STRING, "
        "ice_axe_raw STRING, crampons_raw STRING, hire_revenue_raw STRING"
    ),
}

# Closed enumerations of the data model.
DIFFICULTIES = ("moderate", "hard", "advanced")
EMPLOYMENT_TYPES = ("employed", "freelance")
SEASONS = ("winter", "summer")
TOUR_STATUSES = ("draft", "open", "full", "cancelled")
BOOKING_STATUSES = ("pending", "confirmed", "cancelled", "amended")
PAYMENT_STATUSES = ("pending", "paid", "refund_pending", "refunded", "failed")
UNPAID_CHANNELS = ("organic", "direct", "referral")
PAID_CHANNELS = ("paid_search", "paid_social", "email")
CHANNELS = UNPAID_CHANNELS + PAID_CHANNELS
DEVICES = ("mobile", "desktop", "tablet")
EQUIPMENT = ("boots", "waterproofs", "poles", "helmet", "ice_axe", "crampons")
RATINGS = ("overall_rating", "guide_rating", "route_rating", "safety_rating", "value_rating")
UK_LATITUDE = (49.5, 61.0)
UK_LONGITUDE = (-8.5, 2.0)
MAX_PARTY = 3


# ------------------------------------------------------------------ contracts


@dataclass(frozen=True)
class Check:
    """A named row rule; NULL passes, missing values are the business of ``Field.nullable``."""

    label: str
    passes: Callable[[Column], Column]


def one_of(values: tuple[str, ...]) -> Check:
    return Check(f"isin({', '.join(values)})", lambda c: c.isin(*values))


def between(low: float, high: float) -> Check:
    return Check(f"between({low}, {high})", lambda c: c.between(low, high))


def above(limit: float) -> Check:
    return Check(f"above({limit})", lambda c: c > limit)


def at_least(limit: float) -> Check:
    return Check(f"at_least({limit})", lambda c: c >= limit)


@dataclass(frozen=True)
class Field:
    type: str
    checks: tuple[Check, ...] = ()
    nullable: bool = False
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    fields: dict[str, Field]
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {f.type}" for name, f in self.fields.items())

    @property
    def keys(self) -> list[tuple[str, ...]]:
        return [(name,) for name, f in self.fields.items() if f.unique] + list(self.unique)


KEY = Field("BIGINT", unique=True)
ID = Field("BIGINT")
ID_OPT = Field("BIGINT", nullable=True)
TEXT = Field("STRING")
TEXT_OPT = Field("STRING", nullable=True)
FLAG = Field("BOOLEAN")
FLAG_OPT = Field("BOOLEAN", nullable=True)
DAY = Field("DATE")
MOMENT = Field("TIMESTAMP_NTZ")
MOMENT_OPT = Field("TIMESTAMP_NTZ", nullable=True)
NUMBER = Field("DOUBLE")
DATE_KEY = Field("INT")
DATE_KEY_OPT = Field("INT", nullable=True)
MONEY_POSITIVE = Field("DECIMAL(18,2)", (above(0),))
MONEY_FROM_ZERO = Field("DECIMAL(18,2)", (at_least(0),))
NUMBER_POSITIVE = Field("DOUBLE", (above(0),))
NUMBER_FROM_ZERO = Field("DOUBLE", (at_least(0),))
COUNT = Field("BIGINT", (at_least(0),))
SHARE = Field("DOUBLE", (between(0, 1),))
RATING = Field("INT", (between(1, 5),), nullable=True)
PARTY = Field("INT", (between(1, MAX_PARTY),))


def enum(values: tuple[str, ...]) -> Field:
    return Field("STRING", (one_of(values),))


CLEAN = {
    "Region": Contract({"region_id": KEY, "name": TEXT, "slug": TEXT}),
    "Guide": Contract(
        {
            "guide_id": KEY,
            "first_name": TEXT,
            "last_name": TEXT,
            "qualifications": TEXT_OPT,
            "years_experience": Field("INT", (between(0, 60),)),
            "languages": TEXT,
            "employment_type": enum(EMPLOYMENT_TYPES),
            "day_rate_gbp": MONEY_POSITIVE,
            "primary_region": TEXT,
            "active": FLAG,
            "discount_tendency_pct": Field("DOUBLE", (between(0, 0.25),)),
        }
    ),
    "Route": Contract(
        {
            "route_id": KEY,
            "name": TEXT,
            "region": TEXT,
            "difficulty": enum(DIFFICULTIES),
            "distance_km": NUMBER_POSITIVE,
            "duration_hours": NUMBER_POSITIVE,
            "mountain_height_m": Field("INT", (above(0),)),
            "elevation_gain_m": Field("INT", (at_least(0),)),
            "is_featured": FLAG,
            "active": FLAG,
            "trailhead_lat": Field("DOUBLE", (between(*UK_LATITUDE),)),
            "trailhead_lon": Field("DOUBLE", (between(*UK_LONGITUDE),)),
        }
    ),
    "ScheduledTour": Contract(
        {
            "tour_id": KEY,
            "route_id": ID,
            "guide_id": ID_OPT,
            "date": DAY,
            "season": enum(SEASONS),
            "start_time": TEXT,
            "price_pp": MONEY_POSITIVE,
            "max_group_size": PARTY,
            "status": enum(TOUR_STATUSES),
        }
    ),
    "Booking": Contract(
        {
            "booking_id": KEY,
            "tour_id": ID,
            "booking_reference": Field("STRING", unique=True),
            "party_size": PARTY,
            "contact_name": TEXT,
            "contact_email": TEXT_OPT,
            "contact_email_invalid": FLAG,
            "contact_phone": TEXT,
            "emergency_contact": TEXT_OPT,
            "notes": TEXT_OPT,
            "status": enum(BOOKING_STATUSES),
            "list_price": MONEY_POSITIVE,
            "discount_pct": Field("DOUBLE", (between(0, 0.30),)),
            "discount_applied": FLAG,
            "total_price": MONEY_POSITIVE,
            "created_at": MOMENT,
            "archived_at": MOMENT_OPT,
        }
    ),
    "Payment": Contract(
        {
            "payment_id": KEY,
            "booking_id": KEY,
            "stripe_payment_intent_id": TEXT,
            "stripe_checkout_session_id": TEXT,
            "stripe_refund_id": TEXT_OPT,
            "amount": MONEY_POSITIVE,
            "currency": enum(("GBP",)),
            "status": enum(PAYMENT_STATUSES),
            "paid_at": MOMENT_OPT,
            "refunded_at": MOMENT_OPT,
        }
    ),
    "Review": Contract(
        {
            "booking_id": KEY,
            **{r: RATING for r in RATINGS},
            "comment_length": Field("INT", (at_least(0),)),
            "would_recommend": FLAG_OPT,
        }
    ),
    "Weather": Contract(
        {
            "date": DAY,
            "region": TEXT,
            "temperature_c": NUMBER,
            "rain_mm": NUMBER_FROM_ZERO,
            "wind_speed_kmh": NUMBER_FROM_ZERO,
            "visibility_km": NUMBER_FROM_ZERO,
            "snow_depth_cm": NUMBER_FROM_ZERO,
            "storm_warning": FLAG,
        }
    ),
    "BookingAttribution": Contract({"booking_id": KEY, "channel": enum(CHANNELS)}),
    "Marketing": Contract(
        {
            "campaign": TEXT,
            "channel": TEXT,
            "month": DAY,
            "spend": MONEY_FROM_ZERO,
            "clicks": COUNT,
            "impressions": COUNT,
            "conversions": COUNT,
            "revenue": MONEY_FROM_ZERO,
        }
    ),
    "WebsiteAnalytics": Contract(
        {
            "week_starting": DAY,
            "traffic_source": TEXT,
            "device": enum(DEVICES),
            "sessions": COUNT,
            "users": COUNT,
            "bounce_rate": SHARE,
            "conversion_rate": SHARE,
            "browser": TEXT,
            "country": TEXT,
        }
    ),
    "EquipmentHire": Contract(
        {"booking_id": KEY, **{item: FLAG_OPT for item in EQUIPMENT}, "hire_revenue": MONEY_FROM_ZERO}
    ),
}

# ------------------------------------------------------------------ star schema

STAR = {
    "DimDate": Contract(
        {
            "date_id": Field("INT", unique=True),
            "full_date": Field("DATE", unique=True),
            "day": Field("INT"),
            "month": Field("INT"),
            "month_name": TEXT,
            "quarter": Field("INT"),
            "year": Field("INT"),
            "day_of_week": Field("INT"),
            "day_name": TEXT,
            "is_weekend": FLAG,
            "calendar_season": TEXT,
            "week_start_date": DAY,
            "week_end_date": DAY,
            "week_number": Field("INT"),
            "retail_year": Field("INT"),
            "is_bank_holiday": FLAG,
            "is_summer_holiday": FLAG,
        }
    ),
    "DimRegion": Contract(
        {"region_id": KEY, "name": Field("STRING", unique=True), "slug": Field("STRING", unique=True)}
    ),
    "DimGuide": Contract(
        {
            "guide_id": KEY,
            "first_name": TEXT,
            "last_name": TEXT,
            "full_name": TEXT,
            "qualifications": TEXT_OPT,
            "years_experience": Field("INT"),
            "languages": TEXT,
            "employment_type": enum(EMPLOYMENT_TYPES),
            "day_rate_gbp": Field("DECIMAL(18,2)"),
            "primary_region_id": ID,
            "active": FLAG,
            "discount_tendency_pct": NUMBER,
        },
        references={"primary_region_id": ("DimRegion", "region_id")},
    ),
    "DimRoute": Contract(
        {
            "route_id": KEY,
            "name": TEXT,
            "region_id": ID,
            "difficulty": enum(DIFFICULTIES),
            "distance_km": NUMBER,
            "duration_hours": NUMBER,
            "mountain_height_m": Field("INT"),
            "elevation_gain_m": Field("INT"),
            "is_featured": FLAG,
            "active": FLAG,
            "trailhead_lat": NUMBER,
            "trailhead_lon": NUMBER,
        },
        references={"region_id": ("DimRegion", "region_id")},
    ),
    "DimCustomer": Contract(
        {
            "customer_id": KEY,
            "contact_email": Field("STRING", unique=True),
            "contact_name": TEXT,
            "contact_phone": TEXT,
        }
    ),
    "DimMarketingChannel": Contract(
        {
            "channel_id": KEY,
            "channel_name": Field("STRING", (one_of(CHANNELS),), unique=True),
            "channel_type": enum(("paid", "unpaid")),
        }
    ),
    "FactBookings": Contract(
        {
            "booking_id": KEY,
            "booking_reference": Field("STRING", unique=True),
            "tour_id": ID,
            "customer_id": ID,
            "route_id": ID,
            "guide_id": ID_OPT,
            "region_id": ID,
            "channel_id": ID_OPT,
            "tour_date_id": DATE_KEY,
            "created_date_id": DATE_KEY,
            "season": enum(SEASONS),
            "status": enum(BOOKING_STATUSES),
            "party_size": PARTY,
            "list_price": Field("DECIMAL(18,2)"),
            "discount_pct": NUMBER,
            "discount_applied": FLAG,
            "total_price": Field("DECIMAL(18,2)"),
            "lead_time_days": Field("INT"),
            "contact_email_invalid": FLAG,
        },
        references={
            "customer_id": ("DimCustomer", "customer_id"),
            "route_id": ("DimRoute", "route_id"),
            "guide_id": ("DimGuide", "guide_id"),
            "region_id": ("DimRegion", "region_id"),
            "channel_id": ("DimMarketingChannel", "channel_id"),
            "tour_date_id": ("DimDate", "date_id"),
            "created_date_id": ("DimDate", "date_id"),
        },
    ),
    "FactPayments": Contract(
        {
            "payment_id": KEY,
            "booking_id": KEY,
            "amount": Field("DECIMAL(18,2)"),
            "currency": enum(("GBP",)),
            "status": enum(PAYMENT_STATUSES),
            "paid_date_id": DATE_KEY_OPT,
            "refunded_date_id": DATE_KEY_OPT,
        },
        references={
            "booking_id": ("FactBookings", "booking_id"),
            "paid_date_id": ("DimDate", "date_id"),
            "refunded_date_id": ("DimDate", "date_id"),
        },
    ),
    "FactReviews": Contract(
        {
            "booking_id": KEY,
            "customer_id": ID,
            "route_id": ID,
            "guide_id": ID_OPT,
            **{r: RATING for r in RATINGS},
            "comment_length": Field("INT"),
            "would_recommend": FLAG_OPT,
        },
        references={
            "booking_id": ("FactBookings", "booking_id"),
            "customer_id": ("DimCustomer", "customer_id"),
            "route_id": ("DimRoute", "route_id"),
            "guide_id": ("DimGuide", "guide_id"),
        },
    ),
    "FactEquipmentHire": Contract(
        {
            "booking_id": KEY,
            "customer_id": ID,
            **{item: FLAG for item in EQUIPMENT},
            "hire_revenue": Field("DECIMAL(18,2)"),
        },
        references={
            "booking_id": ("FactBookings", "booking_id"),
            "customer_id": ("DimCustomer", "customer_id"),
        },
    ),
    "FactMarketing": Contract(
        {
            "marketing_id": KEY,
            "campaign": TEXT,
            "channel_id": ID,
            "month_date_id": DATE_KEY,
            "spend": Field("DECIMAL(18,2)"),
            "clicks": ID,
            "impressions": ID,
            "conversions": ID,
            "revenue": Field("DECIMAL(18,2)"),
        },
        references={
            "channel_id": ("DimMarketingChannel", "channel_id"),
            "month_date_id": ("DimDate", "date_id"),
        },
    ),
    "FactWebsiteAnalytics": Contract(
        {
            "website_analytics_id": KEY,
            "week_date_id": DATE_KEY,
            "channel_id": ID,
            "device": enum(DEVICES),
            "sessions": ID,
            "users": ID,
            "bounce_rate": NUMBER,
            "conversion_rate": NUMBER,
            "browser": TEXT,
            "country": TEXT,
        },
        references={
            "week_date_id": ("DimDate", "date_id"),
            "channel_id": ("DimMarketingChannel", "channel_id"),
        },
    ),
    "FactWeather": Contract(
        {
            "weather_id": KEY,
            "date_id": DATE_KEY,
            "region_id": ID,
            "temperature_c": NUMBER,
            "rain_mm": NUMBER,
            "wind_speed_kmh": NUMBER,
            "visibility_km": NUMBER,
            "snow_depth_cm": NUMBER,
            "storm_warning": FLAG,
        },
        unique=(("date_id", "region_id"),),
        references={"date_id": ("DimDate", "date_id"), "region_id": ("DimRegion", "region_id")},
    ),
}

# Facts are laid out in folders by the year of this date key; stored facts carry it as an extra column.
DATE_YEAR = "date_year"
PARTITION_DATE = {
    "FactBookings": "tour_date_id",
    "FactMarketing": "month_date_id",
    "FactWebsiteAnalytics": "week_date_id",
    "FactWeather": "date_id",
}

QUALITY_LOG = "run_started_at TIMESTAMP, table STRING, metric STRING, stage STRING, value DOUBLE, notes STRING"
RUN_EVENTS = "run_id STRING, job STRING, table STRING, state STRING, at TIMESTAMP, note STRING"
