"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 2).
Each query is evaluated in full through the ``noop`` sink (no collect); the reported time is the
warm median of BENCH_REPEAT runs after one warm-up pass over all queries. ``incremental_run`` is the
second load of ``batch_incremental`` alone; its first load is not timed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "valid_employees",
    "bad_employee_audit",
    "quality_counts",
    "employee_rank",
    "employee_dim_ids",
    "sales_fact_assigned",
    "scd1_merge",
    "scd2_merge",
    "fact_employee_as_of",
    "retailer_moving_sums",
    "sales_cube",
    "batch_first_load",
    "batch_incremental",
    "stream_scd1_merge",
]


def second_load(spark, sf_dir: str):
    """Run the first load; returns a function that runs the second."""
    from starloom.plans import fixtures as fx
    from starloom.plans import queries
    from starloom.session import scratch_path

    root = scratch_path(spark, "bench-incremental")
    queries._load(spark, fx.batch_inputs(spark, sf_dir, 1), root)
    return lambda: queries._load(spark, fx.batch_inputs(spark, sf_dir, 2), root, day=1, lookback=queries._LOOKBACK)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from starloom.plans.queries import QUERIES
    from starloom.session import local_session

    spark = local_session(app="starloom-bench", cores=cpus, shuffle_partitions=max(int(cpus), 1) * 2)

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def incremental_run() -> float:
        second = second_load(spark, sf_dir)
        t0 = time.perf_counter()
        second()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up: JIT, file listing caches, Python workers
        run_once(name)
    times = {name: round(statistics.median(run_once(name) for _ in range(repeat)), 3) for name in HEADLINE}
    times["incremental_run"] = round(incremental_run(), 3)
    spark.stop()
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times[n] for n in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )


if __name__ == "__main__":
    main()
