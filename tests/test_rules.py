"""Known answers of the column rules."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from starmart.functions import dates, numbers, text


def apply(spark, values, *rules, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = df.select("i", *[r.alias(f"r{n}") for n, r in enumerate(rules)]).orderBy("i").collect()
    return [tuple(r[1:]) if len(rules) > 1 else r[1] for r in rows]


def test_titled_capitalises_after_any_non_letter(spark):
    raw = ["  jack's rake ", "o'neil-smith", "4000s", "CMD Arête", "\tSNOWDON\n", "   ", None, "ßung x"]
    expected = ["Jack'S Rake", "O'Neil-Smith", "4000S", "Cmd Arête", "Snowdon", None, None, "Ssung X"]
    assert apply(spark, raw, text.titled("v")) == expected
    assert expected == [(v.strip().title() or None) if v else None for v in raw]


def test_titled_equals_str_title_on_mixed_text(spark):
    raw = ["a1b2 c", "x_y-z", "l'été à la plage", "ÅNGSTRÖM öl", "mc donald", "ALL CAPS", "tab\tsep", "1st 2ND"]
    assert apply(spark, raw, text.titled("v")) == [v.strip().title() for v in raw]


def test_titled_equals_str_title_on_random_ascii(spark):
    rng = random.Random(5)
    raw = ["".join(rng.choice("abcXYZ'-_ 0129.\t&(\x01") for _ in range(rng.randrange(14))) for _ in range(3000)]
    assert apply(spark, raw, text.capitalised("v")) == [v.title() for v in raw]


def test_stripped_equals_str_strip(spark):
    raw = [f"{b}a{b}b{b}" for b in text.BLANKS] + [text.BLANKS + "x" + text.BLANKS, text.BLANKS, "", "\u200bx"]
    assert apply(spark, raw, text.stripped("v")) == [v.strip() for v in raw]
    assert all(b.isspace() for b in text.BLANKS)
    assert {chr(i) for i in range(0x3001) if chr(i).isspace()} == set(text.BLANKS)


def test_currency(spark):
    raw = ["£99.95", "GBP 99.95", "99.95 GBP", "99.95", "£1,133.78", None, "n/a", "12 gbp", ""]
    found = apply(spark, raw, numbers.currency("v"))
    assert [None if v is None else float(v) for v in found] == [99.95, 99.95, 99.95, 99.95, 1133.78, None, None, 12.0, None]


def test_distance(spark):
    assert apply(spark, ["14.5 km", "14.5", " 3KM", None, "far"], numbers.distance_km("v")) == [14.5, 14.5, 3.0, None, None]


def test_yes_no(spark):
    raw = ["yes", "Y", "1", "  NO ", "false", "0", "True", "maybe", None]
    assert apply(spark, raw, numbers.yes_no("v")) == [True, True, True, False, False, False, True, None, None]


@pytest.mark.parametrize(
    ("raw", "address", "invalid"),
    [
        ("jane.doe at example.com", "jane.doe@example.com", False),
        ("not-an-email", "not-an-email", True),
        (" jane@example.com ", "jane@example.com", False),
        ("a at b at example.com", "a at b at example.com", True),
        ("x at jane@example.com", "x at jane@example.com", True),
        ("jane at example", "jane at example", True),
        (None, None, True),
    ],
)
def test_email(spark, raw, address, invalid):
    assert apply(spark, [raw], *text.email("v")) == [(address, invalid)]


def test_country(spark):
    raw = ["UK", " u.k. ", "Deutschland", "neverland", None]
    expected = [("United Kingdom", False), ("United Kingdom", False), ("Germany", False), ("Neverland", True), (None, True)]
    assert apply(spark, raw, *text.country("v")) == expected


def test_clip_keeps_null(spark):
    assert apply(spark, [-0.5, 0.5, 1.5, None], numbers.clipped("v"), type_="double") == [0.0, 0.5, 1.0, None]


def test_tolerant_dates(spark):
    raw = ["2024-02-29", "2024-13-01", "soon", None]
    assert apply(spark, raw, dates.tolerant_date("v")) == [datetime.date(2024, 2, 29), None, None, None]


def test_month_arithmetic_carries_surplus_days(spark):
    from starmart.plans.reports import months_back

    d = datetime.date
    days = [d(2025, 3, 31), d(2025, 3, 15), d(2001, 11, 4)]
    found = apply(spark, days, months_back(F.col("v"), 13), type_="date")
    assert found == [d(2024, 3, 2), d(2024, 2, 15), d(2000, 10, 4)]


def test_bands(spark):
    assert apply(spark, [0, 7, 8, 30, 31, 90, 91], dates.lead_time_bucket("v"), type_="int") == [
        "0-7 days", "0-7 days", "8-30 days", "8-30 days", "31-90 days", "31-90 days", "90+ days",
    ]
    assert apply(spark, [4, 5, 14, 15], dates.experience_band("v"), type_="int") == [
        "Junior (<5 yrs)", "Experienced (5-15 yrs)", "Experienced (5-15 yrs)", "Veteran (15+ yrs)",
    ]
