"""Cleaning jobs: read raw CSV, clean, validate, store, log.

    spark-submit -m starmart.plans.pipeline RAW_DIR CLEAN_DIR LOG_DIR WAREHOUSE_DIR EXPORT_DIR
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import cleaning, warehouse
from starmart.plans.ledger import Run
from starmart.plans.quality import CLEANING, Cleaned, to_log
from starmart.plans.validation import first_failures, schema_gaps, validate
from starmart.schemas import CLEAN
from starmart.session import get_session, releasing
from starmart.sources.files import append_log, read_clean, read_raw, write_table


@dataclass(frozen=True)
class Entity:
    """A cleaned table: its raw file, its cleaner, and the cleaned tables that the cleaner looks keys up in."""

    raw: str
    clean: Callable[..., Cleaned]
    parents: tuple[str, ...] = ()


ENTITIES = {
    "Region": Entity("regions", cleaning.clean_regions),
    "Guide": Entity("guides", cleaning.clean_guides),
    "Route": Entity("routes", cleaning.clean_routes),
    "ScheduledTour": Entity("scheduled_tours", cleaning.clean_scheduled_tours, ("Route",)),
    "Booking": Entity("bookings", cleaning.clean_bookings, ("ScheduledTour",)),
    "Payment": Entity("payments", cleaning.clean_payments, ("Booking",)),
    "Review": Entity("reviews", cleaning.clean_reviews, ("Booking",)),
    "Weather": Entity("weather", cleaning.clean_weather, ("Region",)),
    "BookingAttribution": Entity("booking_attribution", cleaning.clean_booking_attribution, ("Booking",)),
    "Marketing": Entity("marketing", cleaning.clean_marketing),
    "WebsiteAnalytics": Entity("website_analytics", cleaning.clean_website_analytics),
    "EquipmentHire": Entity("equipment_hire", cleaning.clean_equipment_hire, ("Booking",)),
}
CORE = ("Region", "Guide", "Route", "ScheduledTour", "Booking", "Payment")
EXTENSIONS = ("Review", "Weather", "BookingAttribution", "Marketing", "WebsiteAnalytics", "EquipmentHire")


def _store(run: Run, cleaned: Cleaned, out_dir: str, log_dir: str) -> DataFrame:
    """Write one cleaned table, then log and validate the written rows."""
    spark, path = run.spark, f"{out_dir}/{cleaned.name}"
    write_table(cleaned.frame, path)
    stored = spark.read.parquet(path)
    contract = CLEAN[cleaned.name]
    gaps = schema_gaps(stored, contract)
    if gaps:
        raise TypeError(f"{cleaned.name}: columns differ from the contract: {gaps}")
    with releasing(spark):
        # One row per rule: small enough to look at here.
        failures = sum(r["failures"] for r in validate(stored, contract).collect())
    entry = to_log(spark, [(cleaned.name, "validation_failures", CLEANING, float(failures), "")], run.started)
    append_log(cleaned.quality(stored, run.started).unionByName(entry), log_dir, run.run_id)
    run.stored(cleaned.name)
    if failures:
        print(f"{cleaned.name} has {failures} failures:")
        with releasing(spark):
            first_failures(stored, contract).show(truncate=False)
    return read_clean(spark, out_dir, cleaned.name)


def parents_first(names: Sequence[str]) -> list[str]:
    """The tables in an order in which each comes after those of its parents that are among them."""
    return list(TopologicalSorter({n: [p for p in ENTITIES[n].parents if p in names] for n in names}).static_order())


def run_tables(
    spark: SparkSession, job: str, names: Sequence[str], raw_dir: str, out_dir: str, log_dir: str
) -> dict[str, DataFrame]:
    """Clean and store tables; parents that are not among them are read as an earlier run has stored them."""
    done: dict[str, DataFrame] = {}
    with Run(spark, log_dir, job) as run:
        for name in parents_first(names):
            entity = ENTITIES[name]
            parents = [done[p] if p in done else read_clean(spark, out_dir, p) for p in entity.parents]
            done[name] = _store(run, entity.clean(read_raw(spark, raw_dir, entity.raw), *parents), out_dir, log_dir)
    return done


def run_core(spark: SparkSession, raw_dir: str, out_dir: str, log_dir: str) -> dict[str, DataFrame]:
    """Region, guide, route, tour, booking and payment."""
    return run_tables(spark, "core", CORE, raw_dir, out_dir, log_dir)


def run_extensions(spark: SparkSession, raw_dir: str, out_dir: str, log_dir: str) -> dict[str, DataFrame]:
    """Review, weather, attribution, marketing, website and equipment; needs the stored regions and bookings."""
    return run_tables(spark, "extensions", EXTENSIONS, raw_dir, out_dir, log_dir)


def main(raw_dir: str, clean_dir: str, log_dir: str, warehouse_dir: str, export_dir: str) -> None:
    spark = get_session("starmart")
    run_core(spark, raw_dir, clean_dir, log_dir)
    run_extensions(spark, raw_dir, clean_dir, log_dir)
    star = warehouse.build_warehouse(spark, clean_dir, warehouse_dir)
    warehouse.export_csv(star, export_dir)


if __name__ == "__main__":
    main(*sys.argv[1:6])
