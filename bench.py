"""Benchmark the headline queries.

Runs each query cold (fresh memo of the shared stages) at $BENCH_SF_DIR
(default /root/testdata/sf0.1) on local[$BENCH_CPUS], forcing full execution
with the no-op sink, and prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "harmonized_panel",       # scan + joins + aggregation + full outer join
    "quality_flags",          # grouping sets + distributed quantile + lookups
    "final_view",             # flagship: flags, lags, nowcast, guardrail, intervals
    "run_summary",            # final view + robust z + reliability audit
    "nowcast_summary_month",  # audit summary at a grain
    "stress_summary",         # 30-repeat backtest of four models in one job
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from fillwise.plans.catalog import REGISTRY
    from fillwise.plans.context import reset
    from fillwise.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # warm-up at the smallest scale, not timed: JVM class loading and JIT for every
    # code path the headline queries use
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for key in ("final_view", "stress_summary"):
            REGISTRY[key](spark, warm).write.format("noop").mode("overwrite").save()
    reset()
    times = {}
    for key in HEADLINE:
        reset()
        t0 = time.time()
        REGISTRY[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
