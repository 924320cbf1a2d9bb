"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Every query is executed
in full through the ``noop`` sink (all rows produced, none collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from restock.plans import catalog  # noqa: E402
from restock.session import get_session  # noqa: E402

HEADLINE = [
    "rolling_features", "inventory_features", "greedy_plan", "plan_explained", "plan_audit",
    "capacity_days", "transport_costs", "trend_weekly_forecast", "forecast_error",
    "fourier_forecast", "execution_summary", "execution_long", "warehouse_kpis",
    "balanced_plan", "capacity_rule", "gbt_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    names = [n for n in HEADLINE if n in catalog.QUERIES]
    if len(sys.argv) > 1:
        names = sys.argv[1:]
    # warm-up: JVM, Python workers and the parquet footer cache
    catalog.QUERIES["daily_sales"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001  (report, keep the one-line contract)
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_total",
           "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
