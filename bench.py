"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from catalog.queries import QUERIES
from shiftledger.session import local_session

HEADLINE = [
    "work_day_agg",
    "event_intervals",
    "activity_union",
    "detail_report",
    "employee_days",
    "summary_report",
    "column_widths",
    "facet_values",
    "facet_filter_multi",
    "table_search",
    "table_page",
    # the paths built for scale: the split of hot employee-days, the join of a large roster
    "event_intervals_split",
    "summary_report_split",
    "summary_report_large_roster",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in HEADLINE:
        run(name)
    seconds = {name: round(min(run(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
