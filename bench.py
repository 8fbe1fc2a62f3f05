"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: the headline set).  Each query is run to
completion with a ``noop`` write (every column computed, nothing shipped to
the driver); time includes planning.  One untimed warm-up pass over the same
queries runs first (warm JVM, as the baseline figures were taken), then
``BENCH_PASSES`` (default 3) timed passes; each query reports its median.
Every timed run recomputes its data from the Parquet tables.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "kpi_region_daily_paid", "kpi_daily_paid", "kpi_unpaid_region_daily", "kpi_course_enrollment",
    "kpi_top_courses_latest", "kpi_access_mix", "gold_run_metrics", "fact_student_daily",
    "fact_course_enrollment_event", "mv_course_enrollment_region_daily", "dim_student",
    "silver_students_clean", "silver_courses", "bronze_email_lookup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("orelake-bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             # AQE merges small shuffle partitions down to this size; the default (1 MB) leaves
             # CPU-heavy text parsing of a few-MB shuffle on one or two tasks.
             .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from orelake.catalog import QUERIES

    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in QUERIES]
    for name in names:  # warm-up pass (JIT, class loading, file listing)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(passes):
        for name in names:
            t0 = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.time() - t0)
    times = {name: round(statistics.median(v), 3) for name, v in runs.items()}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
