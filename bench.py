"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 5; the best run of each query counts),
BENCH_EVENT_LOG (optional folder: Spark's event log is written there, for
stage and task times). One untimed pass over all queries warms the JVM first.
Each query runs to completion through the ``noop`` sink, so the timing covers
the whole plan and no result is pulled to the driver.

The ``csv_job_*`` entries run the four jobs the way they run in production:
``run`` on a CDR CSV (``events`` written once as CSV with a header, untimed),
writing the result CSV and the manifest.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from callstats.plans.cdr_runs import write_cdr_csv  # noqa: E402
from callstats.plans.jobs import JOBS, run  # noqa: E402
from callstats.plans.queries import QUERIES  # noqa: E402
from callstats.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "top_spend",
    "usage_heatmap",
    "outlier_events",
    "revenue_total",
    "top_spend_lineitem",
    "revenue_lineitem",
    "outlier_events_split",
    "outlier_events_shuffle",
    "parsed_heatmap",
    "group_stats",
    "heavy_hitters",
    "stats_lookup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "5")))
    event_log = os.environ.get("BENCH_EVENT_LOG")
    log_conf = (
        {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log, "spark.eventLog.compress": "false"}
        if event_log
        else {}
    )
    spark = build_session(
        "callstats-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=2 * cpus,
        extra={
            "spark.driver.memory": "8g",
            "spark.sql.files.maxPartitionBytes": "64m",
            "spark.ui.showConsoleProgress": "false",
            **log_conf,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    csv = write_cdr_csv(spark, sf_dir)
    runs = scratch_path(spark, "bench-runs")
    jobs = {f"csv_job_{name}": name for name in JOBS}

    def run_once(name: str) -> None:
        if name in jobs:
            run(spark, jobs[name], csv, runs, "bench")
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    names = HEADLINE + list(jobs)
    failed: dict[str, str] = {}
    for name in names:
        try:
            run_once(name)
        except Exception as exc:  # reported in the JSON line, the others still run
            failed[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200] if str(exc) else ''}"

    times: dict[str, float | None] = {}
    for name in names:
        if name in failed:
            times[name] = None
            continue
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run_once(name)
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 4)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_best_query_sec",
                "value": round(sum(t for t in times.values() if t is not None), 4),
                "unit": "sec",
                "queries": times,
                **({"failed": failed} if failed else {}),
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
