"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric": ..., "value": total_sec, "unit": "sec",
"queries": {name: sec}, "sf": ...}.  Each query is run to completion with a
no-op sink (``write.format("noop")``), so the timing covers the full plan
without driver-side collection.  Every query runs ``BENCH_REPEAT`` times
(default 2) and the fastest run is reported (steady state after JIT and
code generation); ``cold`` holds the first-run total.
"""
from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "build_features", "hourly_cube", "station_popularity", "top_stations", "station_hourly", "add_lags",
    "add_lags_global", "chrono_split", "trip_summary", "duration_hist", "top_routes", "station_geo",
    "describe_by", "box_stats", "kde", "histogram", "corr_scan", "hourly_wide", "forecast", "forecast_wide",
    "mae_rmse_wmape", "compare_runs", "drift_ks", "drift_psi", "monthly_report", "order_cube",
    "segment_lags", "stream_hourly", "train_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from velocube.session import get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus), extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    })
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="velocube-bench-"))
    from velocube.catalog import QUERIES
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up: JVM classes, Python workers
    QUERIES["hourly_cube"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times, cold = {}, {}
    for n in names:
        runs = []
        for _ in range(repeat):
            t0 = time.time()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[n], cold[n] = round(min(runs), 3), round(runs[0], 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cold": round(sum(cold.values()), 3), "repeat": repeat, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
