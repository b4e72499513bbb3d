"""Report semantics on a small hand-written star: ties, empty groups, boundaries."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.plans import insights, measures, reports
from starmart.functions import calendar

d = datetime.date
FIRST = d(2019, 1, 1)


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


def booking(i, customer, day, status="confirmed", price=100, route=1, guide=1, region=1, channel=1, discount=0.0):
    return (
        i, f"R{i}", i, customer, route, guide, region, channel, key(day), key(day), "summer", status, 2,
        Decimal(price), discount, discount > 0, Decimal(price) * (1 - Decimal(str(discount))), 0, False,
    )


COHORT = {1: 0, 2: 1, 3: 182, 4: 183, 5: 365, 6: 366}


@pytest.fixture(scope="module")
def star(spark):
    from starmart.plans.warehouse import dim_marketing_channel
    from starmart.schemas import STAR

    rows = []
    for customer, gap in COHORT.items():
        rows.append(booking(len(rows) + 1, customer, FIRST))
        rows.append(booking(len(rows) + 1, customer, FIRST + datetime.timedelta(gap), "amended", 50, route=2))
    rows.append(booking(20, 7, d(2019, 6, 3), "cancelled", 80, guide=2, discount=0.1))
    rows.append(booking(21, 7, d(2019, 6, 4), "confirmed", 600, route=3, guide=None, channel=None, region=2))
    rows.append(booking(22, 8, d(2020, 6, 4), "confirmed", 600, route=4, guide=2, region=2))
    span = spark.sql("SELECT date'2019-01-01' AS lo, date'2021-12-31' AS hi")

    def frame(name, data):
        return spark.createDataFrame(data, STAR[name].ddl)

    routes = [(i, f"Route {i}", 1 if i < 3 else 2, "hard", 1.0, 1.0, 1, 1, True, True, 55.0, -3.0) for i in (1, 2, 3, 4)]
    guides = [(i, "A", f"B{i}", f"A B{i}", None, 4 * i, "en", "employed", Decimal(100), 1, True, 0.1) for i in (1, 2, 3)]
    return {
        "DimDate": calendar.date_dimension(span),
        "DimRegion": frame("DimRegion", [(1, "North", "north"), (2, "South", "south")]),
        "DimGuide": frame("DimGuide", guides),
        "DimRoute": frame("DimRoute", routes),
        "DimCustomer": frame("DimCustomer", [(i, f"c{i}@x.com", f"C{i}", "0") for i in range(1, 9)]),
        "DimMarketingChannel": dim_marketing_channel(spark),
        "FactBookings": frame("FactBookings", rows),
        "FactPayments": frame("FactPayments", [(1, 1, Decimal(10), "GBP", "paid", 20190101, None),
                                               (2, 2, Decimal(20), "GBP", "refunded", 20190101, 20190111),
                                               (3, 3, Decimal(30), "GBP", "refunded", None, 20190111)]),
        "FactReviews": frame("FactReviews", [(1, 1, 1, 1, 5, 4, None, 3, None, 10, True), (2, 1, 2, 1, None, 3, 1, 1, 1, 5, False)]),
        "FactEquipmentHire": frame("FactEquipmentHire", [(1, 1, True, True, True, True, True, True, Decimal(7))]),
        "FactMarketing": frame("FactMarketing", [(1, "a", 1, 20190101, Decimal(0), 10, 100, 2, Decimal(40)),
                                                 (2, "b", 4, 20190101, Decimal(10), 10, 100, 0, Decimal(40))]),
        "FactWeather": frame("FactWeather", [(1, 20190603, 1, 1.0, 16.0, 1.0, 1.0, 0.0, False), (2, 20190604, 1, 1.0, 0.0, 1.0, 1.0, 0.0, True)]),
    }


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize("most", [reports.SLICE_ROWS, 4])
def test_stored_slices_are_the_whole_view(spark, star, monkeypatch, most):
    monkeypatch.setattr(reports, "SLICE_ROWS", most)
    doubled = star["FactBookings"].union(star["FactBookings"].limit(3)).union(star["FactBookings"].limit(1).withColumn("booking_id", F.lit(None).cast("bigint")))
    whole = star | {"FactBookings": doubled}
    found = reports.stored_enriched(whole)
    expected = reports.bookings_enriched(whole)
    assert found.dtypes == expected.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert most > 4 or all("bookings-enriched" in f for f in found.inputFiles())


def test_cohort_boundaries(star):
    got = {r.cohort_month: r for r in reports.cohort_retention(star).collect()}
    january = got["2019-01"]
    # gaps of 1 and 182 days count for six months, up to 365 for twelve; a same-day rebooking does not
    assert (january.cohort_size, january.rebooked_6m, january.rebooked_12m) == (6, 2, 4)
    assert january.retention_6m == 0.3333


def test_rebooking_gaps_include_same_day(star):
    got = sorted(rows(reports.rebooking_gaps(star), "customer_id", "days_to_next_booking"))
    assert got == [(c, g) for c, g in COHORT.items()]
    assert rows(reports.repeat_customer_intervals(star, 2), "customer_id", "days_to_next_booking") == [(1, 0), (2, 1)]


def test_many_bookings_on_one_day(spark, star):
    hot = spark.createDataFrame([booking(i, 1, FIRST) for i in range(200)], star["FactBookings"].schema)
    gaps = reports.rebooking_gaps({**star, "FactBookings": hot}).collect()
    assert [(r.days_to_next_booking, r.pairs) for r in gaps] == [(0, 199)]
    assert reports.repeat_customer_intervals({**star, "FactBookings": hot}).count() == 50


def test_top_routes_share_ties(star):
    got = rows(reports.top_routes_by_region(star, 1), "region", "route", "revenue_rank")
    assert sorted(got) == [("North", "Route 1", 1), ("South", "Route 3", 1), ("South", "Route 4", 1)]


def test_guide_without_bookings_is_kept(star):
    idle = [r for r in reports.guide_performance(star).collect() if r.guide_id == 3][0]
    assert (idle.bookings, idle.revenue, idle.cancellation_rate) == (0, 0, None)
    board = rows(reports.guide_leaderboard(star), "full_name", "region_revenue_rank")
    assert board == [("A B1", 1), ("A B2", 2), ("A B3", 3)]  # equal revenue of 600: the smaller guide id leads


def test_enriched_keeps_bookings_without_guide_or_channel(star):
    got = [r for r in reports.bookings_enriched(star).collect() if r.booking_id == 21][0]
    assert (got.guide_name, got.marketing_channel, got.region_name) == (None, None, "South")


def test_channel_mix_keeps_idle_channels(star):
    got = {r.channel_name: r for r in reports.channel_mix(star).collect()}
    assert len(got) == 6
    assert (got["email"].year, got["email"].spend) == (None, 0)


def test_marketing_guards(star):
    got = {r.channel_name: (r.roas, r.cost_per_booking) for r in reports.marketing_performance(star).collect()}
    assert got == {"organic": (None, 0.0), "paid_search": (4.0, 0.0)}


def test_weather_flag(star):
    got = rows(reports.weather_flagged_cancellations(star), "booking_id", "weather_flagged")
    assert got == [(20, 1)]
    share = insights.weather_share_of_cancellations(star).first()
    assert (share.cancellations, share.weather_flagged, share.weather_flagged_share) == (1, 1, 1.0)


def test_reports_with_parameters(star):
    report = reports.guide_performance_report(star, 1, 2019).first()
    assert (report.bookings, float(report.revenue), report.avg_guide_rating) == (6, 600.0, 3.5)
    assert reports.guide_performance_report(star, 3, 2019).first().bookings == 0
    route = reports.route_performance_report(star, 1).first()
    assert (route.bookings, route.avg_rating) == (7, 5.0)  # six confirmed and one cancelled booking


def test_views_reconcile(star):
    total = sum(r.revenue for r in reports.monthly_revenue(star).collect())
    confirmed = star["FactBookings"].where("status = 'confirmed'").agg({"total_price": "sum"}).first()[0]
    assert total == confirmed


def test_registered_views(spark, star):
    assert len(reports.register_views(star)) == 7
    assert spark.sql("SELECT count(*) FROM vw_customer_summary").first()[0] == 8


def test_yoy(star):
    got = {r.year: r.yoy_pct for r in insights.yearly_revenue(star).collect()}
    assert got[2019] is None and got[2020] == -50.0


def test_measure_filters_and_blank(star):
    assert measures.measure(star, "revenue", ["region"], {"year": 2019}).count() == 2
    empty = measures.measure(star, "cancellation_rate", [], {"year": 2030}).first()[0]
    assert empty is None
    assert measures.measure(star, "average_days_to_refund").first()[0] == 10.0


def test_repeat_customers_ignore_cancelled(star):
    got = measures.measures(star, ["repeat_customers", "total_customers"]).first()
    assert tuple(got) == (6, 8)


def test_guide_cost_counts_a_day_once(star):
    got = {r.guide: float(r.guide_cost) for r in measures.measure(star, "guide_cost", ["guide"], {"guide": ["A B1", "A B2"]}).collect()}
    # guide 1: days 0, 1, 182, 183, 365 and 366; guide 2: one day that was not cancelled
    assert got == {"A B1": 600.0, "A B2": 100.0}


def test_performance_index_treats_missing_rating_as_zero(star):
    got = {r.guide_id: r.performance_index for r in measures.guide_performance_index(star).collect()}
    assert got[2] == pytest.approx(0.4 * 600 / 1800 + 0.2 * 0.5)


def test_new_customers_and_last_year(star):
    got = {r.year: r.new_customers for r in measures.measure(star, "new_customers", ["year"]).collect()}
    assert got == {2019: 7, 2020: 1}
    past = {r.year: r.revenue_last_year for r in measures.revenue_vs_last_year(star, [], [], {"year": 2020}).collect()}
    assert past == {2020: 1200}


def test_tour_statuses(spark, star):
    tours = spark.createDataFrame([(1, 3, False), (2, 2, False), (99, 3, False), (3, 3, True)], "tour_id long, max_group_size int, ops_cancelled boolean")
    got = {r.tour_id: r.status for r in insights.tour_statuses(tours, star["FactBookings"]).collect()}
    assert got == {1: "open", 2: "full", 99: "open", 3: "cancelled"}
