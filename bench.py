"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of driver tables, ``BENCH_CPUS`` the local
cores, ``BENCH_REPEATS`` the timed runs after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rxtally.checks.queries import QUERIES  # noqa: E402
from rxtally.session import local_session  # noqa: E402

HEADLINE = [
    "q1_raw_items",
    "a1_quarterly_totals",
    "a2_monthly_totals",
    "a3_model_totals",
    "a4_distinct_patients",
    "j3_join_drug_by_month",
    "q2_all_grains",
    "q3_identification_table",
    "q5_quarterly_figures",
    "m2_price_within_cells",
    "m3_fit_statistics",
    "m5_nested_by_aic",
    "m6_cell_diagnostics",
    "m8_weighted_sums",
    "q8_expected_totals",
    "q9_indicators",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores)
    times = {}
    for name in HEADLINE:
        query = QUERIES[name]
        run(query, spark, folder)
        times[name] = round(statistics.median(run(query, spark, folder) for _ in range(repeats)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
