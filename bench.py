"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) set the data and the
cores. Each query runs once to warm up and three times for the clock; the middle one counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salespanel.workloads import all_queries

HEADLINES = (
    "upload_cleaned",
    "regular_panel",
    "seasonal_imputation",
    "classical_forecast",
    "backtest_expanding",
    "metric_roll_up",
    "prediction_intervals",
    "monthly_by_department_article",
    "trailing_totals",
    "report_by_department",
    "report_by_article",
    "accuracy_summary_excluding",
    "forecast_json_rows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("salespanel-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds, rows = all_queries(), {}, {}
    for name in HEADLINES:
        runs = []
        for _ in range(4):
            started = time.perf_counter()
            rows[name] = len(queries[name](spark, sf_dir).collect())
            runs.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows": rows, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
