"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starmart import registry  # noqa: E402
from starmart.session import get_session  # noqa: E402

HEADLINE = (
    "rq1_revenue_by_region",
    "rq2_top_routes_by_region",
    "rq3_guide_leaderboard",
    "rq4_month_over_month_growth",
    "rq5_repeat_customer_intervals",
    "rq6_cancellation_drivers",
    "rq7_marketing_channel_mix",
    "rq8_cohort_retention",
    "rv1_bookings_enriched",
    "rv2_monthly_revenue",
    "rv3_route_performance",
    "rv4_guide_performance",
    "rv5_customer_summary",
    "rv6_weather_flagged_cancellations",
    "rv7_marketing_performance",
    "c05_clean_booking",
    "c05_clean_booking_log",
    "v07_failure_counts",
    "b01_dim_date",
    "b06_dim_customer",
    "b08_fact_bookings",
    "m_dashboard_executive",
    "m08_guide_cost",
    "m24_guide_performance_index",
    "a19_median_of_a_hot_group",
    "a27_rollup_calendar",
    "j18_validity_interval_join",
)
REPEATS = 3


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    registry.load()
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    seconds: dict[str, float] = {}
    for name in names or HEADLINE:
        runs = []
        for _ in range(REPEATS):
            begin = time.perf_counter()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
