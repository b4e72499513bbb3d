"""Raw CSV files to warehouse and exports, on hand-written rows with known defects."""

import pytest
from pyspark.sql import functions as F

from starmart.plans import ledger, pipeline, quality, validation, warehouse
from starmart.schemas import CLEAN, RAW, STAR
from starmart.sources import files

RAW_ROWS = {
    "regions": ["1, SNOWDONIA ", "1,snowdonia", "2,lake district"],
    "guides": [
        "1,ann,o'neil,ML; WML,3,English; Welsh,Employed,£120.00,snowdonia,True,0.05",
        "1,second,copy,,3,English,Employed,1,snowdonia,True,0.05",
        '2,BOB,smith,,20,English, FREELANCE ,GBP 1\\,150.50,LAKE DISTRICT,False,0.1',
    ],
    "routes": [
        "1,jack's rake,lake district,HARD,14.5 km,5,900,700,True,True,54.4,-3.1",
        "2,crib goch,snowdonia, hard,10,6,920,,False,True,53.1,-4.0",
        "3,tryfan,snowdonia,Hard,8.25 km,5,915,801,False,True,53.1,-4.0",
        "4,far away,snowdonia,extreme,8,5,915,801,False,True,10.0,-4.0",
    ],
    "scheduled_tours": [
        "10,1,1.0,2023-06-01,Summer,07:30 ,£50.00,3,OPEN",
        "11,2,,2023-06-02,summer,08:00,60,3,full",
        "12,99,2.0,2023-06-03,winter,08:00,-1,3,open",
    ],
    "bookings": [
        "100,10,B-1,2,jane doe,jane.doe at example.com,0123 ,,,Confirmed,£100.00,0.1,True,£90.00,2023-05-01 10:00:00,",
        "101,10,B-1,2,copy,copy@example.com,0123,,,confirmed,100,0,False,100,2023-05-01,",
        "102,11,B-2,3,JANE DOE-SMITH,Jane.Doe@example.com,0456,,,cancelled,180,0,False,170,2023-05-20 09:00:00,not a date",
        "103,11,B-3,4,max,not-an-email,0789,,,pending,60,0,True,60,2023-05-21,",
        "104,77,B-4,1,eve,,0999,,,amended,60,0,False,60,2023-05-22,",
    ],
    "payments": [
        "1,100,pi1,cs1,,£90.00,gbp,Paid,2023-05-02 08:00:00,",
        "2,102,pi2,cs2,re2,170,GBP,refunded,2023-05-21,2023-06-30",
        "3,555,pi3,cs3,,10,EUR,lost,bad,",
    ],
    "reviews": ["100,5,,4,5,6,10,YES", "100,1,1,1,1,1,1,no", "103,4,4,4,4,4,0,perhaps"],
    "weather": [
        "2023-06-02,SNOWDONIA,10,20,5,9,0,True",
        "2023-06-02, snowdonia,11,0,5,9,0,False",
        "2023-06-02,atlantis,11,-1,5,9,0,False",
    ],
    "booking_attribution": ["100, Organic", "102,EMAIL", "103,billboard"],
    "marketing": ["summer push,EMAIL,2023-06,£10.00,5,50,1,\"£1,133.78\"", "seo,organic,2023-05,-1,5,50,1,0"],
    "website_analytics": ["2023-05-29,organic,Mobile,10,5,1.5,0.1,Chrome,UK", "2023-05-29,email,watch,10,5,0.5,,Safari,Narnia"],
    "equipment_hire": ["100,yes,NO,y,0,maybe,,£12.50", "999,no,no,no,no,no,no,-1"],
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    raw = root / "raw"
    raw.mkdir()
    for name, lines in RAW_ROWS.items():
        header = ",".join(f.split()[0] for f in RAW[name].split(", "))
        body = [line.replace("GBP 1\\,150.50", '"GBP 1,150.50"') for line in lines]
        (raw / f"{name}_raw.csv").write_text("\n".join([header, *body]) + "\n")
    clean, log, out = (str(root / x) for x in ("clean", "log", "warehouse"))
    tables = pipeline.run_core(spark, str(raw), clean, log)
    tables |= pipeline.run_extensions(spark, str(raw), clean, log)
    star = warehouse.build_warehouse(spark, clean, out)
    return {"clean": tables, "log": spark.read.parquet(log), "log_dir": log, "raw": str(raw), "star": star, "out": out, "root": root}


def metrics(built, name):
    rows = built["log"].where(f"table = '{name}' AND metric <> 'row_count'").collect()
    return {r.metric: r.value for r in rows}


def test_log_counts_every_defect(built):
    assert metrics(built, "Region") == {"duplicates_removed": 1, "completeness": 1, "validation_failures": 0}
    guide = metrics(built, "Guide")
    assert (guide["duplicates_removed"], guide["missing_qualifications"], guide["currency_strings_parsed"]) == (1, 1, 2)
    route = metrics(built, "Route")
    assert route["elevation_gain_imputed"] == 1
    assert route["distance_unit_strings_parsed"] == 2
    assert route["invalid_difficulty_values"] == 1
    assert route["coordinates_outside_uk_bounds"] == 1
    tour = metrics(built, "ScheduledTour")
    assert (tour["invalid_price_rows"], tour["orphan_route_references"]) == (1, 1)
    booking = metrics(built, "Booking")
    assert booking["duplicate_booking_references_removed"] == 1
    assert booking["malformed_emails_repaired"] == 1
    assert booking["malformed_emails_unrepaired"] == 2  # the odd one and the missing one
    assert booking["inconsistent_discount_flag"] == 1
    assert booking["total_price_discount_mismatch"] == 1
    assert booking["party_size_out_of_range"] == 1
    assert booking["orphan_tour_references"] == 1
    assert booking["completeness"] == round(11 / 12, 4)
    payment = metrics(built, "Payment")
    assert (payment["currency_casing_fixed"], payment["orphan_booking_references"]) == (1, 1)
    assert payment["validation_failures"] == 2  # currency and status
    review = metrics(built, "Review")
    assert (review["duplicates_removed"], review["missing_guide_rating"], review["ratings_out_of_range"]) == (1, 1, 1)
    weather = metrics(built, "Weather")
    assert (weather["duplicates_removed"], weather["unrecognised_region"], weather["negative_rain_values"]) == (1, 1, 1)
    assert metrics(built, "BookingAttribution")["invalid_channel_values"] == 1
    assert metrics(built, "Marketing")["negative_spend_rows"] == 1
    website = metrics(built, "WebsiteAnalytics")
    assert (website["country_names_standardised"], website["country_unrecognised_variant"], website["invalid_device_values"]) == (1, 1, 1)
    hire = metrics(built, "EquipmentHire")
    assert (hire["negative_revenue_rows"], hire["orphan_booking_references"]) == (1, 1)


def test_row_counts_by_stage(built):
    got = {r.table: (r.raw, r.cleaned) for r in quality.stage_summary(built["log"]).collect()}
    assert got["Booking"] == (5, 4) and got["Marketing"] == (2, 2) and len(got) == 12


def test_cleaned_values(built):
    guides = {r.guide_id: r for r in built["clean"]["Guide"].collect()}
    assert (guides[1].first_name, guides[1].last_name, float(guides[1].day_rate_gbp)) == ("Ann", "O'Neil", 120.0)
    assert (guides[2].employment_type, float(guides[2].day_rate_gbp), guides[2].qualifications) == ("freelance", 1150.5, None)
    routes = {r.route_id: r for r in built["clean"]["Route"].collect()}
    assert routes[1].name == "Jack'S Rake"
    assert routes[2].elevation_gain_m == 750  # median of 700 and 801 is 750.5, truncated
    hire = {r.booking_id: r for r in built["clean"]["EquipmentHire"].collect()}[100]
    assert (hire.boots, hire.waterproofs, hire.poles, hire.helmet, hire.ice_axe) == (True, False, True, False, None)
    website = {r.device: r for r in built["clean"]["WebsiteAnalytics"].collect()}
    assert (website["mobile"].bounce_rate, website["watch"].conversion_rate, website["watch"].country) == (1.0, None, "Narnia")


def test_star_schema(built):
    star = built["star"]
    for name in warehouse.LOAD_ORDER:
        assert validation.schema_gaps(star[name], STAR[name]) == []
        assert validation.validate(star[name], STAR[name]).where("check = 'unique' AND failures > 0").isEmpty()
    customers = [(r.customer_id, r.contact_email, r.contact_name, r.contact_phone) for r in star["DimCustomer"].orderBy("customer_id").collect()]
    assert customers == [(1, "jane.doe@example.com", "Jane Doe-Smith", "0456"), (2, "not-an-email", "Max", "0789")]


def test_bookings_fact_and_rejects(spark, built):
    facts = {r.booking_id: r for r in built["star"]["FactBookings"].collect()}
    assert set(facts) == {100, 102, 103}
    assert (facts[100].tour_date_id, facts[100].created_date_id, facts[100].lead_time_days) == (20230601, 20230501, 31)
    assert (facts[100].customer_id, facts[100].route_id, facts[100].region_id, facts[100].channel_id) == (1, 1, 2, 1)
    assert (facts[102].guide_id, facts[103].channel_id) == (None, None)
    assert warehouse.rejected_bookings(spark, built["out"]).count() == 1  # no address and an unknown tour


def test_the_manifest_tells_what_was_loaded(spark, built):
    told = {(r.table, r.measure): (r.rows, r.total) for r in spark.read.parquet(f"{built['out']}/Manifest").collect()}
    assert {t for t, _ in told} == set(warehouse.LOAD_ORDER)
    assert told["FactBookings", "total_price"] == (3, 90.0 + 170 + 60) and told["FactPayments", "amount"] == (3, 270.0)
    again = {(r.table, r.measure): (r.rows, r.total) for r in warehouse.manifest(warehouse.open_warehouse(spark, built["out"])).collect()}
    assert told == again


def test_the_joins_of_the_fact_run_once(spark, built, tmp_path, monkeypatch):
    calls = []
    real = warehouse.fact_bookings
    monkeypatch.setattr(warehouse, "fact_bookings", lambda *a: calls.append(1) or real(*a))
    writes = []
    write = warehouse.write_table
    monkeypatch.setattr(warehouse, "write_table", lambda df, path, *by: writes.append((path.rsplit("/", 1)[-1], by)) or write(df, path, *by))
    warehouse.build_warehouse(spark, str(built["root"] / "clean"), str(tmp_path / "w"))
    assert len(calls) == 1 and writes.count(("FactBookings", ("outcome", "date_year"))) == 1
    assert [w for w, _ in writes].count("FactBookings") == 1


def test_references_resolve(built):
    star = built["star"]
    left = {
        (r.table, r.column): r.failures
        for name in ("DimRoute", "FactBookings", "FactPayments", "FactMarketing", "FactWebsiteAnalytics", "FactWeather")
        for r in validation.reference_counts(star, STAR, name).collect()
    }
    assert left.pop(("FactPayments", "booking_id")) == 1  # the payment of an unknown booking is counted, not dropped
    assert not any(left.values())


def test_calendar_spans_all_sources(built):
    r = built["star"]["DimDate"].agg({"date_id": "max"}).first()
    assert r[0] == 20230630  # the refund is the latest date
    assert built["star"]["DimDate"].agg({"date_id": "min"}).first()[0] == 20230501


def test_export(spark, built):
    names = warehouse.export_csv(built["star"], str(built["root"] / "export"))
    assert len(names) == 17
    exported = spark.read.csv(str(built["root"] / "export" / "FactBookings"), header=True)
    assert exported.count() == 3 and exported.columns == list(STAR["FactBookings"].fields)


def test_failure_cases_name_the_values(built):
    cases = {(r.column, r.value): r.rows for r in validation.failure_cases(built["clean"]["Payment"], CLEAN["Payment"]).collect()}
    assert cases == {("currency", "EUR"): 1, ("status", "lost"): 1}


def test_log_kpis(built):
    kpis = quality.log_kpis(built["log"]).first()
    assert kpis.total_duplicates_removed == 4  # regions, guides, reviews, weather; booking references are counted apart
    assert kpis.total_validation_failures > 10
    assert 0.9 < kpis.completeness_pct < 1


def test_ledger_tells_runs(spark, built):
    runs = {r.job: r for r in ledger.runs(ledger.events(spark, built["log_dir"])).collect()}
    assert {j: (r.state, r.tables) for j, r in runs.items()} == {"core": ("finished", 6), "extensions": ("finished", 6)}
    assert all(0 < r.duration_seconds < 600 and r.ended_at > r.started_at for r in runs.values())
    assert quality.read_log(spark, built["log_dir"]).count() == built["log"].count()


def test_a_second_run_and_one_that_dies(spark, built, tmp_path, monkeypatch):
    """Readers take each table's newest complete run; a run that dies after three tables replaces three."""
    clean, log = str(tmp_path / "clean"), str(tmp_path / "log")
    pipeline.run_core(spark, built["raw"], clean, log)
    with monkeypatch.context() as patched:
        broken = pipeline.Entity("scheduled_tours", lambda raw, routes: 1 / 0, ("Route",))
        patched.setitem(pipeline.ENTITIES, "ScheduledTour", broken)
        patched.setattr(pipeline, "read_raw", lambda s, d, n: files.read_raw(s, d, n).limit(1))
        with pytest.raises(ZeroDivisionError):
            pipeline.run_core(spark, built["raw"], clean, log)
    # A run that recorded its start and an entry, and then nothing.
    lost = ledger.Run(spark, log, "core")
    lost.record(ledger.STARTED)
    files.append_log(quality.to_log(spark, [("Booking", "completeness", "cleaning", 0.0, "")], lost.started), log, lost.run_id)
    runs = sorted((r.state, r.tables, r.duration_seconds is None) for r in ledger.runs(ledger.events(spark, log)).collect())
    assert runs == [("failed", 3, False), ("finished", 6, False), ("unfinished", 0, True)]
    note = ledger.events(spark, log).where("state = 'failed'").first().note
    assert "division by zero" in note
    counts = {r.table: (r.raw, r.cleaned) for r in quality.stage_summary(quality.read_log(spark, log)).collect()}
    assert {n for n in ("Region", "Guide", "Route") if counts[n] == (1, 1)} == {"Region", "Guide", "Route"}
    assert counts["Booking"] == (5, 4) and len(counts) == 6
    assert quality.log_kpis(quality.read_log(spark, log)).first().total_duplicates_removed is None
    assert {r.table for r in quality.table_rates(quality.read_log(spark, log)).collect()} == set(pipeline.CORE)


def test_parents_come_first():
    every = list(pipeline.ENTITIES)
    order = pipeline.parents_first(every[::-1])
    assert sorted(order) == sorted(every)
    assert all(order.index(p) < order.index(n) for n, e in pipeline.ENTITIES.items() for p in e.parents)


def test_clean_csv_round_trip(spark, built):
    path = str(built["root"] / "csv")
    files.write_csv(built["clean"]["Booking"], path)
    back = files.read_clean_csv(spark, path, "Booking")
    assert back.exceptAll(built["clean"]["Booking"]).isEmpty() and back.count() == 4


def test_year_filter_prunes_folders(spark, built, tmp_path):
    from starmart.plans import measures, reports

    facts = built["star"]["FactBookings"].drop("date_year")
    facts = facts.unionByName(facts.withColumn("tour_date_id", F.col("tour_date_id") - 10000))
    warehouse.load(facts, str(tmp_path), "FactBookings")
    star = {**built["star"], "FactBookings": files.read_star(spark, str(tmp_path), "FactBookings")}
    report = reports.guide_performance_report(star, guide_id=1, year=2023)
    assert report.first().bookings == 1
    plan = reports.in_years(star["FactBookings"], "tour_date_id", [2023])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_year" in plan and "tour_date_id,20230101" in plan
    assert measures.measure(star, "total_bookings", ["region"], {"year": 2023}).agg({"total_bookings": "sum"}).first()[0] == 3
