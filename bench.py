"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE), BENCH_RUNS (default 3).
Each query is run to completion with the ``noop`` sink (full computation,
nothing collected); ``queries`` holds the best run, ``first_run`` the cold one.
``risk_scores`` is run once. The total covers the other queries of the list, so
that it can be held against earlier rounds' totals of the same queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civicstat.plans.catalog import QUERIES  # noqa: E402
from civicstat.session import build_session  # noqa: E402

HEADLINE = [
    "success_rates", "low_performers", "repeat_attempts",
    "growth_by_scope_rollup", "seasonality", "daily_cumulative",
    "anomaly_report", "monthly_interpolated", "forecast", "saturation",
    "training_set", "risk_features", "clean_enrollments", "quality_report",
    "similar_cases_exact", "explanation_requests", "problem_districts", "forecast_backtest", "etl_reports",
]
# not part of the total
NEW = ("forecast_backtest", "etl_reports", "risk_scores")
# minutes of model fitting: run once
ONCE = ["risk_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + ONCE)).split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8), app_name="civicstat-bench")
    # warm-up (not timed): JVM code paths of scans, joins, windows, Python workers
    for w in ("privacy_gate", "repeat_attempts", "anomaly_series", "forecast_backtest"):
        QUERIES[w](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times, first, errors = {}, {}, {}
    for name in names:
        best = None
        try:
            for i in range(1 if name in ONCE else runs):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i == 0:
                    first[name] = round(dt, 3)
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - record and keep benchmarking
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(t for q, t in times.items() if q not in NEW), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "all_queries_total": round(sum(times.values()), 3), "not_in_value": [q for q in times if q in NEW],
                      "runs": runs, "aggregate": "best of runs per query",
                      "first_run_total": round(sum(first.values()), 3), "first_run": first,
                      **({"errors": errors} if errors else {})}))


if __name__ == "__main__":
    main()
