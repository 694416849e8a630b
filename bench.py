"""Benchmark the headline queries.

Runs each query to completion with the no-op sink (full execution, nothing collected)
on local[$BENCH_CPUS] over $BENCH_SF_DIR, $BENCH_RUNS times (default 3; "queries" holds the
best run, "cold_total_sec" the sum of first runs) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surveyspark.plans.catalog import QUERIES  # noqa: E402
from surveyspark.session import get_spark  # noqa: E402

HEADLINE = [
    "imputed_counts",            # flagship: C4 -> P8 -> I6 (group + global modes, one lookup join)
    "impute_by_age_range",       # I6 rows
    "impute_phase2",             # I5: median, mode, group median, modes, recode
    "group_mode",                # A5
    "null_rates_by_cluster",     # V1 / A9
    "corr_matrix",               # V2 / A12
    "crosstab_occupation_age",   # V3 / A14
    "audit_series",              # V6 / A15-A19
    "stratified_split",          # K4 exact ranks without a one-task window
    "corr_matrix_lineitem",      # A12 on lineitem
    "group_median_income",       # A7
    "extract_job",               # V7: CSV extracts -> aligned union -> recode
    "clustering_job",            # M8: K-Means + PCA + profile
    "forest_planted",            # M13 fit + score
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", max(8, 2 * cpus), app_name="surveyspark-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = sys.argv[1:] or HEADLINE
    # warm-up: JVM, parquet footer cache, codegen of the shared survey projection
    QUERIES["row_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times, cold = {}, {}
    for name in names:
        best = None
        for i in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i == 0:
                cold[name] = round(dt, 3)
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "runs": runs, "cold_total_sec": round(sum(cold.values()), 3)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
