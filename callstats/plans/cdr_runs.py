"""Registered queries that run the jobs the way they run in production.

``events`` is written by Spark as a CDR CSV with a header line into the shared
folder, and the four jobs read that text through ``run`` (declared-schema CSV
scan, input count, job, headerless CSV result, manifest). Each query returns
the published result, read back with the job's output schema. The
``stream_*`` queries feed the same CSV, in several files, to the incremental
runs and return the last snapshot.

Column roles of the derived CDR rows: ``caller_id`` is ``USER_<user_id>``,
``receiver_id`` is ``USER_<props.k>``, ``duration_sec`` is ``value``, ``tower_id`` is ``event_type``, ``timestamp`` is ``ts`` as ISO text
to the second (the generator's layout), ``call_type`` is ``event_type`` in
upper case and ``charge_amount`` is ``value``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.plans.jobs import JOBS, run
from callstats.schema import (
    ANOMALY_SCHEMA,
    CDR_SCHEMA,
    HEATMAP_SCHEMA,
    REVENUE_SCHEMA,
    TOP_CALLERS_SCHEMA,
)
from callstats.session import scratch_path
from callstats.sinks.manifest import check_manifests, read_manifests
from callstats.sinks.rejects import RAW_LINE, read_rejects
from callstats.sources.cdr import read_result
from callstats.streaming import read_cdr_stream, start_incremental

RESULT_SCHEMAS = {
    "top_callers": TOP_CALLERS_SCHEMA,
    "tower_heatmap": HEATMAP_SCHEMA,
    "anomalous_calls": ANOMALY_SCHEMA,
    "revenue_recon": REVENUE_SCHEMA,
}

# Threshold for "heavy" keys on the test tables (users have 49-99 events);
# the table queries use it too.
TEST_HEAVY_THRESHOLD = 80

# Number of micro-batches the stream queries are fed in (one file each).
STREAM_BATCHES = 4


def cdr_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the CDR input layout, every row kept."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    cdr = ev.select(
        F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("caller_id"),
        F.concat(F.lit("USER_"), F.get_json_object("props", "$.k")).alias("receiver_id"),
        F.col("value").alias("duration_sec"),
        F.col("event_type").alias("tower_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.upper("event_type").alias("call_type"),
        F.col("value").alias("charge_amount"),
    )
    return cdr.select(*CDR_SCHEMA.names)


def write_cdr_csv(spark: SparkSession, sf_dir: str, max_records_per_file: int | None = None) -> str:
    """Write ``cdr_from_events`` as CSV with a header into the shared folder."""
    path = scratch_path(spark, "cdr-csv")
    writer = cdr_from_events(spark, sf_dir).write.option("header", True)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path)
    return path


def run_on_cdr(spark: SparkSession, sf_dir: str, name: str, **params) -> DataFrame:
    """Job ``name`` run end to end on the CDR CSV; its published result."""
    csv = write_cdr_csv(spark, sf_dir)
    manifest = run(spark, name, csv, scratch_path(spark, "runs"), "r0", **params)
    return read_result(spark, manifest["output_path"], RESULT_SCHEMAS[name])


def job_top_callers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on_cdr(spark, sf_dir, "top_callers")


def job_tower_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on_cdr(spark, sf_dir, "tower_heatmap")


def job_anomalous_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on_cdr(spark, sf_dir, "anomalous_calls")


def job_anomalous_calls_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whale path: callers above the heavy threshold joined by broadcast.
    The threshold is that of the table queries (callers have 49-99 calls)."""
    return run_on_cdr(spark, sf_dir, "anomalous_calls", strategy="split", heavy_threshold=TEST_HEAVY_THRESHOLD)


def job_revenue_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on_cdr(spark, sf_dir, "revenue_recon")


def job_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four jobs on one CDR CSV, then the manifest check over their runs."""
    csv = write_cdr_csv(spark, sf_dir)
    base = scratch_path(spark, "runs")
    for name in JOBS:
        run(spark, name, csv, base, "r0")
    checked = check_manifests(spark, base).select("job_name", "run_id", "actual_rows", "ok")
    manifests = read_manifests(spark, base).select(
        "job_name", "run_id", "input_record_count", "output_record_count", "status"
    )
    return manifests.join(checked, ["job_name", "run_id"])


def kept_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of a CDR CSV in which some charges are no numbers or missing: the
    rejected rows as kept, and how many the run's record counts."""
    csv = scratch_path(spark, "cdr-csv")
    charge = F.when(F.length("caller_id") % 2 == 0, F.concat(F.col("charge_amount"), F.lit(" EUR"))).otherwise(
        F.when(F.col("tower_id") != "view", F.col("charge_amount").cast("string"))
    )
    cdr_from_events(spark, sf_dir).withColumn("charge_amount", charge).write.option("header", True).csv(csv)
    base = scratch_path(spark, "runs")
    record = run(spark, "revenue_recon", csv, base, "r0", keep_rejects=True)
    schema = T.StructType([*CDR_SCHEMA.fields, T.StructField(RAW_LINE, T.StringType())])
    kept = read_rejects(spark, f"{base}/{record['job_name']}/r0", schema)
    return kept.select(
        "caller_id",
        "timestamp",
        F.element_at(F.split(RAW_LINE, ","), -1).alias("raw_charge"),
        F.lit(record["rejected_record_count"]).cast("long").alias("counted"),
    )


def stream_on_cdr(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Job ``name`` kept current by the incremental run while the CDR CSV
    arrives as ``STREAM_BATCHES`` files; the snapshot after the last one."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
    csv = write_cdr_csv(spark, sf_dir, max_records_per_file=max(1, math.ceil(rows / STREAM_BATCHES)))
    files = len(spark.read.text(csv).inputFiles())
    per_trigger = max(1, math.ceil(files / STREAM_BATCHES))
    base = scratch_path(spark, "stream-runs")
    query = start_incremental(
        spark,
        name,
        read_cdr_stream(spark, csv, max_files_per_trigger=per_trigger),
        base,
        scratch_path(spark, "stream-state"),
        run_id="s0",
        input_path=csv,
    )
    query.awaitTermination()
    last = query.lastProgress["batchId"]
    return read_result(spark, f"{base}/{JOBS[name].job_name}/s0-b{last}", RESULT_SCHEMAS[name])


def stream_top_callers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_on_cdr(spark, sf_dir, "top_callers")


def stream_tower_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_on_cdr(spark, sf_dir, "tower_heatmap")


def stream_revenue_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_on_cdr(spark, sf_dir, "revenue_recon")


CDR_QUERIES = {
    "job_top_callers": job_top_callers,
    "job_tower_heatmap": job_tower_heatmap,
    "job_anomalous_calls": job_anomalous_calls,
    "job_anomalous_calls_split": job_anomalous_calls_split,
    "job_revenue_recon": job_revenue_recon,
    "job_manifests": job_manifests,
    "kept_rejects": kept_rejects,
    "stream_top_callers": stream_top_callers,
    "stream_tower_heatmap": stream_tower_heatmap,
    "stream_revenue_recon": stream_revenue_recon,
}
