"""Shuffle bytes, spill and output of the headline queries, from the Spark event log.

usage: python tools/bench_metrics.py [sf_dir]

Runs every headline query of ``bench.py`` once (after a warm-up) in a session that writes an
uncompressed event log into a fresh folder under /tmp, then sums the task metrics of the jobs
submitted while each query ran. ``incremental_run`` is the second load of ``batch_incremental``
alone. The scans are those of ``orders`` (the sales) in the plans. Prints a markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def sales_scans(node: dict) -> int:
    """Scans of the orders table in a plan of the event log."""
    own = node["nodeName"].startswith("Scan parquet") and "orders.parquet" in node.get("metadata", {}).get("Location", "")
    return own + sum(map(sales_scans, node["children"]))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import SparkSession

    from bench import HEADLINE, second_load
    from starloom.plans.queries import QUERIES
    from starloom.session import shared_root

    evdir = tempfile.mkdtemp(prefix="starloom-evlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", evdir)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        run(name)
    windows = []
    for name in HEADLINE:
        t0 = int(time.time() * 1000)
        run(name)
        windows.append((name, t0, int(time.time() * 1000)))
    second = second_load(spark, sf_dir)
    t0 = int(time.time() * 1000)
    second()
    windows.append(("incremental_run", t0, int(time.time() * 1000)))
    spark.stop()

    files = [p for p in glob.glob(f"{evdir}/**", recursive=True) if os.path.isfile(p)]
    log = max(files, key=os.path.getsize)  # the events file (the folder also holds a status marker)
    job_time, stage_job, totals = {}, {}, {n: dict(jobs=0, scans=0, shuffle=0, spill=0, out_bytes=0, out_rows=0) for n, _, _ in windows}
    for line in open(log):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            job_time[e["Job ID"]] = e["Submission Time"]
            for sid in e["Stage IDs"]:
                stage_job[sid] = e["Job ID"]
        elif ev.endswith("SparkListenerSQLExecutionStart"):
            owner = next((n for n, a, b in windows if a <= e["time"] <= b), None)
            if owner:
                totals[owner]["scans"] += sales_scans(e["sparkPlanInfo"])
        elif ev == "SparkListenerTaskEnd" and "Task Metrics" in e:
            job = stage_job.get(e["Stage ID"])
            ts = job_time.get(job)
            owner = next((n for n, a, b in windows if ts is not None and a <= ts <= b), None)
            if owner is None:
                continue
            m = e["Task Metrics"]
            t = totals[owner]
            t["shuffle"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            t["spill"] += m.get("Memory Bytes Spilled", 0) + m.get("Disk Bytes Spilled", 0)
            t["out_bytes"] += m.get("Output Metrics", {}).get("Bytes Written", 0)
            t["out_rows"] += m.get("Output Metrics", {}).get("Records Written", 0)
    for job, ts in job_time.items():
        owner = next((n for n, a, b in windows if a <= ts <= b), None)
        if owner:
            totals[owner]["jobs"] += 1
    print(f"| query ({os.path.basename(sf_dir)}) | sec | jobs | scans of orders | shuffle written | spill | output written | output rows |")
    print("|---|---|---|---|---|---|---|---|")
    for name, a, b in windows:
        t = totals[name]
        print(
            f"| `{name}` | {(b - a) / 1000:.1f} | {t['jobs']} | {t['scans']} | {t['shuffle'] / 2**20:.1f} MiB | {t['spill'] / 2**20:.1f} MiB "
            f"| {t['out_bytes'] / 2**20:.1f} MiB | {t['out_rows']} |"
        )


if __name__ == "__main__":
    main()
