"""Wall seconds of the headline queries: one warm-up, then the median of three runs into a discarding sink.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medloom.plans.queries import QUERIES  # noqa: E402
from medloom.session import build_session  # noqa: E402

HEADLINES = (
    "std_admissions", "std_billing", "std_departments", "std_diagnoses", "std_hospitals", "std_lab_results",
    "std_patients", "std_procedures", "std_providers", "health_all", "profile_orders", "profile_events",
    "kpi_los_monthly", "kpi_occupancy", "kpi_revenue_tieout", "kpi_payer_mix", "kpi_top_codes", "kpi_readmit_30d",
    "kpi_labs", "conform_cpt", "deid_export", "semi_exists", "latest_run_stats", "dup_key_check",
)


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        query = QUERIES[name]
        seconds(spark, query, sf_dir)
        times[name] = round(statistics.median(seconds(spark, query, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
