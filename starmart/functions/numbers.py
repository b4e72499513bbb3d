"""Numeric rules. Money is DECIMAL(18,2), so sums do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.text import col, lowered, stripped

MONEY = "decimal(18,2)"

# Currency marks removed from a price.
CURRENCY_MARKS = "[£,]|GBP|gbp"
DISTANCE_UNIT = "km"
# Spellings of yes and no.
YES = ("true", "yes", "y", "1")
NO = ("false", "no", "n", "0")


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def currency(c: Column | str) -> Column:
    """``£1,133.78`` / ``GBP 99.95`` / ``99.95`` to money; NULL when unreadable."""
    return stripped(F.regexp_replace(col(c).cast("string"), CURRENCY_MARKS, "")).try_cast(MONEY)


def has_currency_mark(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string").rlike(CURRENCY_MARKS), F.lit(False))


def distance_km(c: Column | str) -> Column:
    """``14.5 km`` / ``14.5`` to a number; NULL when unreadable."""
    return stripped(F.replace(F.lower(col(c).cast("string")), F.lit(DISTANCE_UNIT), F.lit(""))).try_cast("double")


def has_distance_unit(c: Column | str) -> Column:
    return F.coalesce(F.contains(F.lower(col(c).cast("string")), F.lit(DISTANCE_UNIT)), F.lit(False))


def yes_no(c: Column | str) -> Column:
    """Yes/no spellings to a boolean; anything else is NULL."""
    text = lowered(col(c).cast("string"))
    return F.when(text.isin(*YES), F.lit(True)).when(text.isin(*NO), F.lit(False))


def clipped(c: Column | str, low: float = 0.0, high: float = 1.0) -> Column:
    """Clamp to a range; NULL stays NULL although greatest/least would skip it."""
    value = col(c)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def whole(c: Column | str) -> Column:
    """Truncate towards zero."""
    return col(c).cast("int")


def differs(a: Column, b: Column, tolerance: str = "0.02") -> Column:
    """Absolute difference beyond a tolerance, in exact decimals."""
    return F.abs(a - b) > F.lit(tolerance).cast("decimal(10,4)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rate(numerator: Column, denominator: Column, places: int = 4) -> Column:
    return F.round(ratio(numerator, denominator), places)


def count_rows() -> Column:
    return F.count(F.lit(1))


def sum_if(condition: Column, value: Column) -> Column:
    """Conditional sum that is 0, not NULL, when no row qualifies."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast(MONEY)))


def avg_exact(value: Column, places: int = 2) -> Column:
    """Null-skipping mean from an exact sum, rounded."""
    return F.round(ratio(F.sum(value), F.count(value)), places)
