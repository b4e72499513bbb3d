"""KPI measures over the star schema, sliced by any dimension attributes.

    measure(star, "cancellation_rate", by=["region"], filters={"year": [2024]})

A measure is an expression over base figures. All base figures of one fact are
computed in a single aggregation, and facts meet only after aggregation, on the
``by`` attributes. Only the dimensions that ``by`` and ``filters`` mention are
joined. Figures that do not add up (distinct counts, ranges) are computed from
the rows of the requested grain, never summed from a finer one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.numbers import MONEY, count_rows, ratio
from starmart.operators import series
from starmart.plans.reports import Star, bad_weather, in_years
from starmart.schemas import MAX_PARTY

Filters = Mapping[str, object]

# Weights of the guide performance index (revenue share, rating, reliability), the best rating.
INDEX_WEIGHTS = (0.4, 0.4, 0.2)
TOP_RATING = 5

# ------------------------------------------------------------------ attributes

# Attributes of a day.
_DATE = (
    "full_date", "day", "month", "month_name", "quarter", "year", "day_of_week", "day_name", "is_weekend",
    "calendar_season", "week_start_date", "week_number", "retail_year", "is_bank_holiday", "is_summer_holiday",
)

# attribute -> (dimension, column); the foreign key is the dimension's key.
ATTRIBUTES: dict[str, tuple[str, str]] = {
    "region": ("DimRegion", "name"),
    "route": ("DimRoute", "name"),
    "difficulty": ("DimRoute", "difficulty"),
    "guide": ("DimGuide", "full_name"),
    "employment_type": ("DimGuide", "employment_type"),
    "experience_band": ("DimGuide", "experience_band"),
    "channel": ("DimMarketingChannel", "channel_name"),
    "channel_type": ("DimMarketingChannel", "channel_type"),
    **{a: ("DimDate", a) for a in _DATE},
}
KEYS = {
    "DimRegion": "region_id",
    "DimRoute": "route_id",
    "DimGuide": "guide_id",
    "DimMarketingChannel": "channel_id",
    "DimDate": "date_id",
}
# Role-playing dates: the key each role stands for.
DATE_ROLES = {
    "tour": "tour_date_id",
    "created": "created_date_id",
    "paid": "paid_date_id",
    "refunded": "refunded_date_id",
}
# Columns of the bookings fact that other facts of the same booking inherit.
BOOKING_COLUMNS = (
    "customer_id", "route_id", "guide_id", "region_id", "channel_id", "tour_date_id", "created_date_id", "season",
    "status", "lead_time_days",
)
BOOKING_FACTS = ("FactPayments", "FactReviews", "FactEquipmentHire")
OWN_DATE = {"FactMarketing": "month_date_id", "FactWebsiteAnalytics": "week_date_id", "FactWeather": "date_id"}


@dataclass(frozen=True)
class Edge:
    """A relationship: the one side filters the many side, if it is active."""

    one: str
    many: str
    key: str
    active: bool = True


# The relationships of the semantic model. A booking carries its route's region. Dates other than the
# tour's are inactive: a measure names the role it wants.
RELATIONSHIPS = (
    Edge("DimRegion", "FactBookings", "region_id"),
    Edge("DimRoute", "FactBookings", "route_id"),
    Edge("DimGuide", "FactBookings", "guide_id"),
    Edge("DimCustomer", "FactBookings", "customer_id"),
    Edge("DimMarketingChannel", "FactBookings", "channel_id"),
    Edge("DimDate", "FactBookings", "tour_date_id"),
    Edge("DimDate", "FactBookings", "created_date_id", active=False),
    Edge("FactBookings", "FactPayments", "booking_id"),
    Edge("FactBookings", "FactReviews", "booking_id"),
    Edge("FactBookings", "FactEquipmentHire", "booking_id"),
    Edge("DimDate", "FactPayments", "paid_date_id", active=False),
    Edge("DimDate", "FactPayments", "refunded_date_id", active=False),
    Edge("DimMarketingChannel", "FactMarketing", "channel_id"),
    Edge("DimDate", "FactMarketing", "month_date_id"),
    Edge("DimMarketingChannel", "FactWebsiteAnalytics", "channel_id"),
    Edge("DimDate", "FactWebsiteAnalytics", "week_date_id"),
    Edge("DimRegion", "FactWeather", "region_id"),
    Edge("DimDate", "FactWeather", "date_id"),
)


def filtering(table: str) -> set[str]:
    """The tables whose filters reach ``table``: itself, and all that active edges lead back to."""
    found, todo = {table}, [table]
    while todo:
        many = todo.pop()
        nearer = {e.one for e in RELATIONSHIPS if e.many == many and e.active} - found
        found |= nearer
        todo += nearer
    return found


def reaches(star: Star, attribute: str, fact: str) -> bool:
    """Whether an attribute filters and splits a fact; one that no table has is an error."""
    if attribute in ATTRIBUTES:
        return ATTRIBUTES[attribute][0] in filtering(fact)
    if attribute in BOOKING_COLUMNS or attribute in ("lead_time_bucket", "booking_id"):
        return "FactBookings" in filtering(fact)
    if fact in star and attribute in _own(star, fact).columns:
        return True
    if not any(attribute in _own(star, n).columns for n in star if n.startswith("Fact") and star[n] is not None):
        raise ValueError(f"no table has the attribute {attribute!r}")
    return False


def _own(star: Star, fact: str) -> DataFrame:
    """The fact as measures see it: a payment's status is no booking's status."""
    return star[fact].withColumnRenamed("status", "payment_status") if fact == "FactPayments" else star[fact]


def _dimension(star: Star, name: str) -> DataFrame:
    df = star[name]
    if name == "DimGuide":
        df = df.withColumn("experience_band", dates.experience_band("years_experience"))
    return df


def _keys_needed(fact: str, attributes: Sequence[str], date_role: str) -> list[str]:
    """Columns of the fact (or its booking) that the attributes are derived from."""
    date_key = OWN_DATE.get(fact, DATE_ROLES[date_role])
    keys = []
    for a in attributes:
        if a == "lead_time_bucket":
            keys.append("lead_time_days")
        elif a in ATTRIBUTES:
            dim = ATTRIBUTES[a][0]
            keys.append(date_key if dim == "DimDate" else KEYS[dim])
        else:
            keys.append(a)
    return list(dict.fromkeys(keys))


def _with_booking_keys(star: Star, fact: str, keys: Sequence[str]) -> DataFrame:
    """The fact; one that lacks some of the keys takes them from its booking."""
    df = _own(star, fact)
    missing = [c for c in keys if c in BOOKING_COLUMNS and c not in df.columns]
    if fact in BOOKING_FACTS and missing:
        df = df.join(star["FactBookings"].select("booking_id", *missing), "booking_id")
    return df


def _described(star: Star, df: DataFrame, fact: str, attributes: Sequence[str], date_role: str) -> DataFrame:
    """Attach attributes, joining only the dimensions they come from."""
    date_key = OWN_DATE.get(fact, DATE_ROLES[date_role])
    if "lead_time_bucket" in attributes:
        df = df.withColumn("lead_time_bucket", dates.lead_time_bucket("lead_time_days"))
    dims: dict[str, list[str]] = {}
    for a in attributes:
        if a in ATTRIBUTES:
            dims.setdefault(ATTRIBUTES[a][0], []).append(a)
    for dim, names in dims.items():
        key = date_key if dim == "DimDate" else KEYS[dim]
        columns = [F.col(ATTRIBUTES[a][1]).alias(f"_{a}") for a in names]
        side = _dimension(star, dim).select(F.col(KEYS[dim]).alias("_key"), *columns)
        df = df.join(side, F.col(key) == F.col("_key"), "left").drop("_key")
        # An attribute replaces a fact column of the same name.
        df = df.drop(*names).withColumnsRenamed({f"_{a}": a for a in names})
    return df


def _listed(values: object) -> list:
    return list(values) if isinstance(values, (list, tuple, set)) else [values]


def _kept(df: DataFrame, filters: Filters) -> DataFrame:
    for a, values in filters.items():
        df = df.where(F.col(a).isin(*_listed(values)))
    return df


def _scanned(star: Star, fact: str, keys: Sequence[str], filters: Filters, date_role: str) -> DataFrame:
    """The fact with all keys; a year filter already reaches the scan as a date-key range."""
    df = _with_booking_keys(star, fact, keys)
    if "year" in filters:
        df = in_years(df, OWN_DATE.get(fact, DATE_ROLES[date_role]), _listed(filters["year"]))
    return df


def sliced(star: Star, fact: str, by: Sequence[str], filters: Filters, date_role: str = "tour") -> DataFrame:
    """The rows of a fact inside the filter context, with the ``by`` attributes attached."""
    wanted = list(dict.fromkeys([*by, *filters]))
    df = _scanned(star, fact, _keys_needed(fact, wanted, date_role), filters, date_role)
    return _kept(_described(star, df, fact, wanted, date_role), filters)


def _aggregated(
    star: Star, fact: str, names: Sequence[str], by: Sequence[str], filters: Filters, date_role: str
) -> DataFrame:
    """Base figures of one fact on the ``by`` grain.

    Figures that add up are first aggregated on the fact's own keys: the
    dimension joins then see one row per key combination, and a key with a
    third of the fact leaves each task as one row.
    """
    if any(BASES[n].again is None for n in names):
        rows = sliced(star, fact, by, filters, date_role)
        return rows.groupBy(*by).agg(*[BASES[n].value().alias(n) for n in names])
    wanted = list(dict.fromkeys([*by, *filters]))
    keys = _keys_needed(fact, wanted, date_role)
    rows = _scanned(star, fact, keys, filters, date_role)
    fine = rows.groupBy(*keys).agg(*[BASES[n].value().alias(f"_{n}") for n in names])
    if not wanted:
        return fine.select(*[F.col(f"_{n}").alias(n) for n in names])
    groups = _kept(_described(star, fine, fact, wanted, date_role), filters)
    return groups.groupBy(*by).agg(*[BASES[n].again(f"_{n}").alias(n) for n in names])


# ------------------------------------------------------------------ base figures


@dataclass(frozen=True)
class Base:
    """A figure aggregated from the rows of one fact.

    ``again`` combines values of a finer grain; None when only the rows will do.
    """

    fact: str
    value: Callable[[], Column]
    again: Callable[[str], Column] | None = F.sum


def _status(*names: str) -> Column:
    return F.col("status").isin(*names)


def _payment(name: str) -> Column:
    return F.col("payment_status") == name


def _if(condition: Callable[[], Column], value: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.sum(F.when(condition(), value()))


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


B, P, R, E = "FactBookings", "FactPayments", "FactReviews", "FactEquipmentHire"
MK, WB, WE = "FactMarketing", "FactWebsiteAnalytics", "FactWeather"

BASES: dict[str, Base] = {
    "total_bookings": Base(B, count_rows),
    "confirmed_bookings": Base(B, lambda: F.count_if(_status("confirmed"))),
    "cancelled_bookings": Base(B, lambda: F.count_if(_status("cancelled"))),
    "revenue": Base(B, _if(lambda: _status("confirmed"), _col("total_price"))),
    "booked_value": Base(B, lambda: F.sum("total_price")),
    "list_value": Base(B, lambda: F.sum("list_price")),
    "discount_given": Base(B, lambda: F.sum(F.col("list_price") - F.col("total_price"))),
    "discounted_bookings": Base(B, lambda: F.count_if(F.col("discount_applied"))),
    "discount_pct_sum": Base(
        B, _if(lambda: F.col("discount_applied"), lambda: F.col("discount_pct").cast("decimal(9,4)"))
    ),
    "confirmed_seats": Base(B, _if(lambda: _status("confirmed"), _col("party_size"))),
    "guide_days": Base(B, lambda: F.countDistinct(F.when(~_status("cancelled"), F.col("tour_date_id"))), None),
    "customers": Base(B, lambda: F.countDistinct("customer_id"), None),
    "first_day": Base(B, lambda: F.min("tour_date_id"), F.min),
    "last_day": Base(B, lambda: F.max("tour_date_id"), F.max),
    "reviews": Base(R, count_rows),
    "overall_sum": Base(R, lambda: F.sum("overall_rating")),
    "overall_n": Base(R, lambda: F.count("overall_rating")),
    "guide_rating_sum": Base(R, lambda: F.sum("guide_rating")),
    "guide_rating_n": Base(R, lambda: F.count("guide_rating")),
    "hires": Base(E, count_rows),
    "hire_revenue": Base(E, lambda: F.sum("hire_revenue")),
    "spend": Base(MK, lambda: F.sum("spend")),
    "clicks": Base(MK, lambda: F.sum("clicks")),
    "conversions": Base(MK, lambda: F.sum("conversions")),
    "campaign_revenue": Base(MK, lambda: F.sum("revenue")),
    "sessions": Base(WB, lambda: F.sum("sessions")),
    "users": Base(WB, lambda: F.sum("users")),
    "bounce_avg": Base(WB, lambda: F.avg("bounce_rate"), None),
    "conversion_avg": Base(WB, lambda: F.avg("conversion_rate"), None),
    "storm_days": Base(WE, lambda: F.count_if("storm_warning")),
    "paid": Base(P, lambda: F.count_if(_payment("paid"))),
    "failed": Base(P, lambda: F.count_if(_payment("failed"))),
    "refunded": Base(P, lambda: F.count_if(_payment("refunded"))),
    "pending_amount": Base(P, _if(lambda: _payment("pending"), _col("amount"))),
    "refund_days": Base(
        P,
        _if(
            lambda: _payment("refunded"),
            lambda: F.datediff(dates.key_date("refunded_date_id"), dates.key_date("paid_date_id")),
        ),
    ),
    "refund_n": Base(
        P, lambda: F.count(F.when(_payment("refunded"), F.col("refunded_date_id") + F.col("paid_date_id")))
    ),
}

# ------------------------------------------------------------------ derived frames

Frame = Callable[[Star, Sequence[str], Filters, str], DataFrame]


def _guide_cost(star: Star, by: Sequence[str], filters: Filters, role: str) -> DataFrame:
    """Day rate once per guide and tour day with a booking that was not cancelled."""
    rows = sliced(star, B, by, filters, role).where(~_status("cancelled"))
    grain = list(dict.fromkeys([*by, "guide_id"]))
    # Days per guide first: one row per guide reaches the rate lookup.
    per_guide = rows.groupBy(*grain).agg(F.countDistinct("tour_date_id").alias("_days"))
    rates = star["DimGuide"].select("guide_id", "day_rate_gbp")
    cost = F.sum(F.col("day_rate_gbp") * F.col("_days")).cast("decimal(28,2)")
    return per_guide.join(rates, "guide_id", "left").groupBy(*by).agg(cost.alias("guide_cost"))


def _repeat_customers(star: Star, by: Sequence[str], filters: Filters, role: str) -> DataFrame:
    """Customers of each group with more than one trip.

    Two contexts meet: trips are counted with the status lifted, as a filter and
    as a slice, all else in force; who is counted follows the whole context. A
    customer is one row with the trips and the few statuses their bookings have.
    """
    grain = [a for a in by if a != "status"]
    other = lifted(filters, "status")
    rows = sliced(star, B, [*grain, "status"], other, role)
    per_customer = rows.groupBy(*grain, "customer_id").agg(
        F.count_if(_status("confirmed", "amended")).alias("_trips"), F.collect_set("status").alias("_statuses")
    )
    if "status" in filters:
        chosen = F.array(*[F.lit(v) for v in _listed(filters["status"])])
        per_customer = per_customer.withColumn("_statuses", F.array_intersect("_statuses", chosen)).where("size(_statuses) > 0")
    if "status" in by:
        per_customer = per_customer.withColumn("status", F.explode("_statuses"))
    return per_customer.groupBy(*by).agg(F.count_if(F.col("_trips") > 1).alias("repeat_customers"))


def _new_customers(star: Star, by: Sequence[str], filters: Filters, role: str) -> DataFrame:
    """Customers counted in the group of their first booking."""
    wanted = list(dict.fromkeys([*by, *filters]))
    keys = [c for c in _keys_needed(B, wanted, role) if c != "customer_id"]
    # The first booking of each customer, with the keys its attributes come from.
    first = star[B].groupBy("customer_id").agg(
        F.min_by(F.struct(*keys, "booking_id"), F.struct("tour_date_id", "booking_id")).alias("_first")
    )
    firsts = first.select("customer_id", *[F.col(f"_first.{c}").alias(c) for c in keys])
    rows = _kept(_described(star, firsts, B, wanted, role), filters)
    return rows.groupBy(*by).agg(count_rows().alias("new_customers"))


def _flagged(star: Star, by: Sequence[str], filters: Filters, role: str) -> DataFrame:
    """Cancelled bookings with bad weather in their region on their day."""
    rows = sliced(star, B, by, filters, role).where(_status("cancelled"))
    bad = star["FactWeather"].where(bad_weather()).select("region_id", F.col("date_id").alias("tour_date_id"))
    keys = list(dict.fromkeys([*by, "region_id", "tour_date_id"]))
    per_day = rows.groupBy(*keys).agg(count_rows().alias("_n"))
    return (
        per_day.join(bad, ["region_id", "tour_date_id"], "left_semi")
        .groupBy(*by)
        .agg(F.sum("_n").alias("flagged_cancellations"))
    )


FRAMES: dict[str, Frame] = {
    "guide_cost": _guide_cost,
    "repeat_customers": _repeat_customers,
    "new_customers": _new_customers,
    "flagged_cancellations": _flagged,
}

# ------------------------------------------------------------------ measures


@dataclass(frozen=True)
class Measure:
    needs: tuple[str, ...]
    value: Callable[[], Column]


def _plain(name: str) -> Measure:
    return Measure((name,), _col(name))


def _quotient(a: str, b: str) -> Measure:
    return Measure((a, b), lambda: ratio(F.col(a), F.col(b)))


def _zero(name: str) -> Column:
    """Blank counts as 0 in sums and differences."""
    return F.coalesce(F.col(name), F.lit(0).cast(MONEY))


def _all_revenue() -> Column:
    return _zero("revenue") + _zero("hire_revenue")


def _net_profit() -> Column:
    return _all_revenue() - _zero("guide_cost")


def _active_days() -> Column:
    return F.datediff(dates.key_date("last_day"), dates.key_date("first_day")) + 1


MEASURES: dict[str, Measure] = {
    "total_bookings": _plain("total_bookings"),
    "confirmed_bookings": _plain("confirmed_bookings"),
    "cancelled_bookings": _plain("cancelled_bookings"),
    "revenue": _plain("revenue"),
    "cancellation_rate": _quotient("cancelled_bookings", "total_bookings"),
    "average_booking_value": _quotient("revenue", "confirmed_bookings"),
    "guide_days_worked": _plain("guide_days"),
    "guide_cost": _plain("guide_cost"),
    "equipment_hire_revenue": _plain("hire_revenue"),
    "total_revenue": Measure(("revenue", "hire_revenue"), _all_revenue),
    "net_profit": Measure(("revenue", "hire_revenue", "guide_cost"), _net_profit),
    "net_profit_margin": Measure(
        ("revenue", "hire_revenue", "guide_cost"), lambda: ratio(_net_profit(), _all_revenue())
    ),
    "average_satisfaction": _quotient("overall_sum", "overall_n"),
    "repeat_customers": _plain("repeat_customers"),
    "total_customers": _plain("customers"),
    "repeat_customer_rate": _quotient("repeat_customers", "customers"),
    "revenue_per_guide_day": _quotient("revenue", "guide_days"),
    "new_customers": _plain("new_customers"),
    "reviews_per_confirmed_booking": _quotient("reviews", "confirmed_bookings"),
    "guide_utilisation": Measure(
        ("guide_days", "first_day", "last_day"), lambda: ratio(F.col("guide_days"), _active_days())
    ),
    "bookings_with_discount_pct": _quotient("discounted_bookings", "total_bookings"),
    "average_discount_pct": _quotient("discount_pct_sum", "discounted_bookings"),
    "total_discount_given": _plain("discount_given"),
    "occupancy_pct": Measure(
        ("confirmed_seats", "confirmed_bookings"),
        lambda: ratio(F.col("confirmed_seats"), F.col("confirmed_bookings") * MAX_PARTY),
    ),
    "marketing_spend": _plain("spend"),
    "marketing_revenue": _plain("campaign_revenue"),
    "marketing_conversions": _plain("conversions"),
    "return_on_spend": _quotient("campaign_revenue", "spend"),
    "acquisition_cost": _quotient("spend", "conversions"),
    "equipment_hire_rate": _quotient("hires", "confirmed_bookings"),
    "storm_warning_days": _plain("storm_days"),
    "weather_flagged_cancellation_rate": Measure(
        ("flagged_cancellations", "cancelled_bookings"),
        lambda: ratio(F.col("flagged_cancellations"), F.col("cancelled_bookings")),
    ),
    "gross_margin": Measure(("revenue", "guide_cost"), lambda: _zero("revenue") - _zero("guide_cost")),
    "discount_pct_of_revenue": _quotient("discount_given", "list_value"),
    "refund_pct": _quotient("refunded", "paid"),
    "payment_success_rate": Measure(("paid", "failed"), lambda: ratio(F.col("paid"), F.col("paid") + F.col("failed"))),
    "outstanding_balance": _plain("pending_amount"),
    "average_price_per_tour": _quotient("booked_value", "confirmed_bookings"),
    "average_days_to_refund": _quotient("refund_days", "refund_n"),
    "conversion_rate": _quotient("conversions", "clicks"),
    "cost_per_booking": _quotient("spend", "conversions"),
    "reviews_per_customer": _quotient("reviews", "customers"),
    "website_sessions": _plain("sessions"),
    "website_users": _plain("users"),
    "average_bounce_rate": _plain("bounce_avg"),
    "average_conversion_rate": _plain("conversion_avg"),
}


def figures(star: Star, names: Sequence[str], by: Sequence[str], filters: Filters, date_role: str) -> DataFrame:
    """Base figures on one grain: one aggregation per fact, stacked and collapsed on ``by``.

    Stacking keeps groups that occur in only some facts and needs no outer join,
    nor a cross join when ``by`` is empty. An attribute that does not reach a
    fact neither filters nor splits it: its figures are those of the attributes
    that do, the same in every group that differs in the others only.
    """
    by_fact: dict[str, list[str]] = {}
    for n in names:
        by_fact.setdefault(BASES[n].fact if n in BASES else B, []).append(n)
    whole: list[DataFrame] = []
    coarser: list[tuple[list[str], DataFrame, list[str]]] = []
    for fact, wanted in by_fact.items():
        own = [a for a in by if reaches(star, a, fact)]
        kept = {a: v for a, v in filters.items() if reaches(star, a, fact)}
        plain, framed = [n for n in wanted if n in BASES], [n for n in wanted if n in FRAMES]
        parts = [_aggregated(star, fact, plain, own, kept, date_role)] if plain else []
        parts += [FRAMES[n](star, own, kept, date_role) for n in framed]
        if len(own) == len(by):
            whole += parts
        else:
            coarser += [(own, p, [c for c in p.columns if c not in own]) for p in parts]
    if whole:
        base = whole[0] if len(whole) == 1 else reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), whole)
        found = [c for c in base.columns if c not in by]
        base = base if len(whole) == 1 else base.groupBy(*by).agg(*[F.max(n).alias(n) for n in found])
    else:
        base = _members(star, by)
    for own, part, found in coarser:
        if not own:
            base = base.withColumns({n: part.select(n).scalar() for n in found})
            continue
        part = part.withColumnsRenamed({a: f"_of_{a}" for a in own})
        match = [F.col(a).eqNullSafe(F.col(f"_of_{a}")) for a in own]
        base = base.join(part, match, "left").drop(*[f"_of_{a}" for a in own])
    return base


def _members(star: Star, by: Sequence[str]) -> DataFrame:
    """The groups of attributes that split none of the facts, taken from their dimension."""
    dims = {ATTRIBUTES[a][0] if a in ATTRIBUTES else None for a in by}
    if len(dims) != 1 or None in dims:
        raise ValueError(f"no fact is split by all of {list(by)}, and no dimension holds them all")
    columns = [F.col(ATTRIBUTES[a][1]).alias(a) for a in by]
    return _dimension(star, dims.pop()).select(*columns).distinct()


def measures(
    star: Star,
    names: Sequence[str],
    by: Sequence[str] = (),
    filters: Filters | None = None,
    date_role: str = "tour",
) -> DataFrame:
    """Several measures on the same grain in one pass."""
    needs = list(dict.fromkeys(n for m in names for n in MEASURES[m].needs))
    base = figures(star, needs, list(by), dict(filters or {}), date_role)
    return base.select(*by, *[MEASURES[m].value().alias(m) for m in names])


def measure(
    star: Star, name: str, by: Sequence[str] = (), filters: Filters | None = None, date_role: str = "tour"
) -> DataFrame:
    return measures(star, [name], by, filters, date_role)


def lifted(filters: Filters, *attributes: str) -> dict[str, object]:
    """The filter context without the filters on some attributes."""
    return {k: v for k, v in filters.items() if k not in attributes}


# ------------------------------------------------------------------ measures with their own shape


def revenue_vs_last_year(
    star: Star, period: Sequence[str] = ("month",), by: Sequence[str] = (), filters: Filters | None = None
) -> DataFrame:
    """Revenue, revenue of the same period last year, growth. Year filters apply to the result, not the past."""
    context = dict(filters or {})
    base = measure(star, "revenue", ["year", *period, *by], lifted(context, "year"))
    with_past = series.same_period_last_year(base, "year", "revenue", "revenue_last_year", period, by)
    with_past = _kept(with_past, {k: v for k, v in context.items() if k == "year"})
    growth = ratio(F.col("revenue") - F.col("revenue_last_year"), F.col("revenue_last_year"))
    return with_past.withColumn("revenue_growth", growth)


def revenue_year_to_date(star: Star, filters: Filters | None = None) -> DataFrame:
    """Running revenue inside each year, one row per tour day with bookings."""
    daily = measure(star, "revenue", ["year", "full_date"], filters).fillna({"revenue": 0})
    return series.year_to_date(daily, "year", "full_date", "revenue", "revenue_ytd")


def bank_holiday_uplift(star: Star, filters: Filters | None = None) -> DataFrame:
    """Revenue per bank holiday over revenue per other day, minus 1; days come from the calendar."""
    context = dict(filters or {})
    sold = measure(star, "revenue", ["is_bank_holiday"], context)
    calendar = _kept(star["DimDate"], {a: v for a, v in context.items() if a in _DATE})
    days = calendar.groupBy("is_bank_holiday").agg(F.countDistinct("date_id").alias("days"))
    stacked = sold.unionByName(days, allowMissingColumns=True)

    def per_day(holiday: bool) -> Column:
        mine = F.col("is_bank_holiday") == holiday
        return ratio(F.sum(F.when(mine, F.col("revenue"))), F.sum(F.when(mine, F.col("days"))))

    return stacked.agg((F.try_divide(per_day(True), per_day(False)) - 1).alias("bank_holiday_uplift"))


def guide_performance_index(star: Star, filters: Filters | None = None) -> DataFrame:
    """Weighted revenue share, rating and reliability of each guide; missing terms count as 0.

    The revenue total ignores filters on guides but keeps all others.
    """
    context = dict(filters or {})
    of_guides = [a for a, (dim, _) in ATTRIBUTES.items() if dim == "DimGuide"] + ["guide_id"]
    total = measure(star, "revenue", [], lifted(context, *of_guides)).scalar()
    names = ["revenue", "guide_rating_sum", "guide_rating_n", "cancelled_bookings", "total_bookings"]
    base = figures(star, names, ["guide_id"], context, "tour").where("guide_id IS NOT NULL")
    w_revenue, w_rating, w_reliable = INDEX_WEIGHTS
    zero = F.lit(0.0)
    index = (
        w_revenue * F.coalesce(ratio(F.col("revenue"), total), zero)
        + w_rating * F.coalesce(ratio(F.col("guide_rating_sum"), F.col("guide_rating_n") * TOP_RATING), zero)
        + w_reliable * (1 - F.coalesce(ratio(F.col("cancelled_bookings"), F.col("total_bookings")), zero))
    )
    return base.select("guide_id", index.alias("performance_index"))


def channel_mix_pct(star: Star, filters: Filters | None = None) -> DataFrame:
    """Bookings per channel as a share of all bookings."""
    per_channel = measure(star, "total_bookings", ["channel"], filters)
    return series.share_of_total(per_channel, "total_bookings", "channel_mix")


def acquisition_by_channel(star: Star) -> DataFrame:
    """Customers by the channel of their first booking."""
    return _new_customers(star, ["channel"], {}, "tour").withColumnRenamed("new_customers", "customers_acquired")
