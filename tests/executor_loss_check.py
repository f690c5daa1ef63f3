"""Run the four jobs while an executor dies, and check the counts stay exact.

Not part of the pytest run (it kills processes and takes a few minutes):

    python tests/executor_loss_check.py [rows] [kill_after_seconds]

Spark runs in ``local-cluster`` mode, so executors are separate JVMs, children
of this process's driver JVM. For each job a clean run is made, then a second
run during which one executor is killed with SIGKILL; its shuffle output is
lost and the map tasks it ran are run again. The check passes when both runs
report the same input and output counts and publish the same rows. For
contrast the input is also counted with an ``observe`` on the scan (a map
stage), which counts the re-run tasks twice.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import tempfile
import threading
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import Observation, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from callstats.plans.jobs import JOBS, run  # noqa: E402
from callstats.sources.cdr import read_cdr, read_result  # noqa: E402


def children(pid: int) -> list[int]:
    out = []
    for d in os.listdir("/proc"):
        if d.isdigit():
            try:
                with open(f"/proc/{d}/stat", encoding="utf-8") as f:
                    if int(f.read().rsplit(")", 1)[1].split()[1]) == pid:
                        out.append(int(d))
            except OSError:
                pass
    return out


def our_executors() -> list[int]:
    """Executor JVMs started by this process's own driver JVM."""
    found = []
    for driver in children(os.getpid()):
        for pid in children(driver):
            try:
                with open(f"/proc/{pid}/cmdline", "rb") as f:
                    if b"CoarseGrainedExecutorBackend" in f.read():
                        found.append(pid)
            except OSError:
                pass
    return found


def kill_one_after(seconds: float, log: list) -> threading.Thread:
    def go():
        time.sleep(seconds)
        pids = our_executors()
        if pids:
            os.kill(pids[0], signal.SIGKILL)
            log.append(pids[0])

    thread = threading.Thread(target=go)
    thread.start()
    return thread


def write_cdr(spark: SparkSession, path: str, rows: int) -> None:
    def h(salt):
        return F.xxhash64(F.col("id"), F.lit(salt))

    whale = F.pmod(F.col("id"), F.lit(3)) == 0
    spark.range(0, rows, numPartitions=16).select(
        F.when(whale, F.lit("WHALE_CALLER_999"))
        .otherwise(F.concat(F.lit("USER_"), F.pmod(h(1), F.lit(50000)).cast("string")))
        .alias("caller_id"),
        F.concat(F.lit("USER_"), F.pmod(h(2), F.lit(50000)).cast("string")).alias("receiver_id"),
        F.when(F.pmod(h(3), F.lit(1000)) == 0, F.lit(30000))
        .otherwise(F.pmod(h(4), F.lit(3591)) + 10)
        .cast("int")
        .alias("duration_sec"),
        F.concat(F.lit("TOWER_"), F.lpad((F.pmod(h(5), F.lit(100)) + 1).cast("string"), 3, "0")).alias("tower_id"),
        F.date_format(
            F.timestamp_seconds(F.lit(1696118400) + F.pmod(h(6), F.lit(2592000))), "yyyy-MM-dd'T'HH:mm:ss"
        ).alias("timestamp"),
        F.lit("VOICE").alias("call_type"),
        ((F.pmod(h(8), F.lit(491)) + 10) / F.lit(100.0)).alias("charge_amount"),
    ).write.option("header", True).csv(path)


def main(rows: int = 20_000_000, kill_after: float = 6.0) -> bool:
    work = tempfile.mkdtemp(prefix="executor-loss-")
    spark = (
        SparkSession.builder.master("local-cluster[2,2,3072]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.files.maxPartitionBytes", "32m")
        .config("spark.executor.memory", "2g")
        .config("spark.checkpoint.dir", f"{work}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    csv = f"{work}/cdr"
    write_cdr(spark, csv, rows)

    def published(manifest, name):
        return sorted(tuple(r) for r in read_result(spark, manifest["output_path"], JOBS[name].schema).collect())

    # Every job, plus the anomaly job with broadcast ruled out: a sort-merge
    # join in which AQE splits the whale's partition.
    cases = [(name, name, {}) for name in JOBS]
    cases.append(("anomalous_calls/sort-merge", "anomalous_calls", {"max_broadcast_rows": 0}))
    ok = True
    for label, name, params in cases:
        tag = label.replace("/", "-")
        clean = run(spark, name, csv, f"{work}/out", f"clean-{tag}", **params)
        killed: list = []
        thread = kill_one_after(kill_after, killed)
        lossy = run(spark, name, csv, f"{work}/out", f"loss-{tag}", **params)
        thread.join()
        same = (
            clean["input_record_count"] == lossy["input_record_count"] == rows
            and clean["output_record_count"] == lossy["output_record_count"]
            and published(clean, name) == published(lossy, name)
        )
        ok &= same
        print(json.dumps({
            "job": label,
            "input": [clean["input_record_count"], lossy["input_record_count"]],
            "output": [clean["output_record_count"], lossy["output_record_count"]],
            "same_rows": same,
            "killed_executor": killed,
        }), flush=True)

    killed = []
    naive = Observation("scan_rows")
    thread = kill_one_after(kill_after, killed)
    scan = read_cdr(spark, csv).observe(naive, F.count(F.lit(1)).alias("rows"))
    scan.groupBy("caller_id").agg(F.sum("charge_amount")).write.format("noop").mode("overwrite").save()
    thread.join()
    print(json.dumps({"map_stage_observe": naive.get["rows"], "rows": rows, "killed_executor": killed}), flush=True)
    spark.stop()
    return ok


if __name__ == "__main__":
    args = [float(a) for a in sys.argv[1:]]
    passed = main(int(args[0]) if args else 20_000_000, args[1] if len(args) > 1 else 6.0)
    print("PASS" if passed else "FAIL")
    sys.exit(0 if passed else 1)
