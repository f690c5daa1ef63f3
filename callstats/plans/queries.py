"""Registered queries over the test tables.

Each query takes ``(spark, sf_dir)``, reads whole tables from ``sf_dir`` and
returns a lazy DataFrame. The driver tables stand in for the CDR input:
``orders`` gives caller (``o_custkey``) and charge (``o_totalprice``);
``events`` gives caller (``user_id``), duration (``value``), tower
(``event_type``) and time (``ts``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.functions.time import ISO_MICROS
from callstats.operators.aggregates import group_stats, heavy_group_stats, heavy_hitters
from callstats.operators.lookup import stats_lookup as stats_lookup_op
from callstats.operators.heavy import heavy_hitters_sketched
from callstats.operators.partitioning import DEFAULT_BUCKETS, repartition_by_key, spread_by_key
from callstats.operators.partitioning import key_bucket as key_bucket_op
from callstats.operators.projection import conform
from callstats.plans.cdr_runs import CDR_QUERIES, TEST_HEAVY_THRESHOLD
from callstats.plans.jobs import (
    JOBS,
    anomalous_calls,
    revenue_recon,
    run_job,
    top_callers,
    tower_heatmap,
    with_hour,
)
from callstats.schema import Roles
from callstats.session import scratch_path
from callstats.sinks.manifest import check_manifests, check_parts, leftovers, read_manifests, write_part_statistics
from callstats.sinks.publish import attempt_of, publish
from callstats.sinks.results import write_parts, write_result
from callstats.sources.cdr import read_result

ORDER_ROLES = Roles(caller="o_custkey", charge="o_totalprice")
EVENT_ROLES = Roles(caller="user_id", duration="value", tower="event_type", timestamp="ts", charge="value")
#: Rows of one partition in the spread placement of the test tables.
SPREAD_ROWS = 500
LINEITEM_ROLES = Roles(caller="l_suppkey", charge="l_extendedprice")



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def top_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_callers(table(spark, sf_dir, "orders"), ORDER_ROLES)


def top_spend_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_callers(table(spark, sf_dir, "lineitem"), LINEITEM_ROLES)


def revenue_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_recon(table(spark, sf_dir, "orders"), ORDER_ROLES)


def revenue_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_recon(table(spark, sf_dir, "lineitem"), LINEITEM_ROLES)


def usage_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tower_heatmap(table(spark, sf_dir, "events"), EVENT_ROLES)


def outlier_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalous_calls(table(spark, sf_dir, "events"), EVENT_ROLES)


def outlier_events_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalous_calls(
        table(spark, sf_dir, "events"), EVENT_ROLES, strategy="split", heavy_threshold=TEST_HEAVY_THRESHOLD
    )


def outlier_events_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``auto`` strategy with broadcast ruled out: the sort-merge path."""
    return anomalous_calls(table(spark, sf_dir, "events"), EVENT_ROLES, max_broadcast_rows=0)


def heavy_hitters_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return heavy_hitters(ev, "user_id", TEST_HEAVY_THRESHOLD).withColumnRenamed("user_id", "caller_id")


def heavy_hitters_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys by a sketch and a recount of its candidates."""
    ev = table(spark, sf_dir, "events")
    found = heavy_hitters_sketched(ev, "user_id", TEST_HEAVY_THRESHOLD)
    return found.withColumnRenamed("user_id", "caller_id")


def key_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement in two levels with half of all rows on one key: per key its
    bucket, rows and partitions."""
    ev = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 2 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("caller_id")
    )
    placed = key_bucket_op(spread_by_key(ev, "caller_id", SPREAD_ROWS), "caller_id")
    at = placed.withColumn("partition", F.spark_partition_id())
    per_part = at.groupBy("caller_id", "bucket", "partition").agg(F.count(F.lit(1)).alias("n"))
    return per_part.groupBy("caller_id", "bucket").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("partitions"),
        F.min(F.when(F.col("partition") < DEFAULT_BUCKETS, F.col("partition"))).alias("first_level"),
    )


def group_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = group_stats(table(spark, sf_dir, "events"), "user_id", "value")
    return stats.select(
        F.col("user_id").alias("caller_id"),
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
    )


def heavy_group_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = heavy_group_stats(table(spark, sf_dir, "events"), "user_id", "value", TEST_HEAVY_THRESHOLD)
    return stats.select(
        F.col("user_id").alias("caller_id"),
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
    )


def stats_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    looked = stats_lookup_op(ev, "user_id", "value", TEST_HEAVY_THRESHOLD)
    return looked.select("event_id", "is_heavy", F.round("mean", 6).alias("mean"))


def events_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` rendered as text in seven shapes, by ``event_id``:
    a layout no format accepts, microseconds, a space for the T, ``Z``, an offset
    (the same time, two hours ahead), nine fraction digits, and whole seconds.
    Every row is kept.
    """
    ev = table(spark, sf_dir, "events")
    seconds = "yyyy-MM-dd'T'HH:mm:ss"
    shapes = [
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss"),
        F.date_format("ts", ISO_MICROS),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.date_format("ts", seconds), F.lit("Z")),
        F.concat(F.date_format(F.expr("ts + interval 2 hours"), seconds), F.lit("+02:00")),
        F.concat(F.date_format("ts", ISO_MICROS), F.lit("123")),
        F.date_format("ts", seconds),
    ]
    text = F.coalesce(*[F.when(F.col("event_id") % 7 == k, shape) for k, shape in enumerate(shapes)])
    return ev.withColumn("ts", text)


def parsed_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events_as_text(spark, sf_dir)
    return with_hour(ev.select("event_id", "ts"), EVENT_ROLES).select("event_id", "hour_of_day")


def parsed_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tower_heatmap(events_as_text(spark, sf_dir), EVENT_ROLES)


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = T.StructType().add("caller_id", T.LongType()).add("duration_sec", T.IntegerType()).add("charge_amount", T.FloatType())
    names = {"caller_id": "user_id", "duration_sec": "value", "charge_amount": "value"}
    return conform(table(spark, sf_dir, "events"), layout, names)


def input_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input count a job takes in its own pass, from the run's manifest."""
    base = scratch_path(spark, "runs")
    run_job(spark, "revenue_recon", table(spark, sf_dir, "events"), base, "r0", roles=EVENT_ROLES)
    return read_manifests(spark, base).select("input_record_count")


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input rows of a heatmap run over times in seven shapes, and those of them
    that were rejected: the shape no format accepts."""
    times = events_as_text(spark, sf_dir)
    record = run_job(spark, "tower_heatmap", times, scratch_path(spark, "runs"), "r0", roles=EVENT_ROLES)
    names = ("input_record_count", "rejected_record_count")
    return spark.range(1).select(*[F.lit(record[n]).cast("long").alias(n) for n in names])


def revenue_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select((F.col("value") / 8).alias("value"))
    return revenue_recon(ev, EVENT_ROLES)


def top_spend_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", (F.col("value") / 8).alias("value"))
    return top_callers(ev, EVENT_ROLES)


def csv_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend of four keys, written and read back: NULL, the text NULL, a text
    with a line break and an empty text."""
    of = F.col("user_id") % 4
    key = F.when(of == 1, "NULL").when(of == 2, "a\nb").when(of == 3, "")
    result = top_callers(table(spark, sf_dir, "events").withColumn("user_id", key), EVENT_ROLES)
    path = scratch_path(spark, "csv-null-keys")
    write_result(result, path, single_file=True)
    return read_result(spark, path, result.schema)


def failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails over an earlier one: the earlier result still stands with
    its manifest, the failure is recorded beside it with the input count, and
    the check reports the run as not ok."""
    base = scratch_path(spark, "runs")
    ev = table(spark, sf_dir, "events")
    run_job(spark, "revenue_recon", ev, base, "r0", roles=EVENT_ROLES)
    bad = ev.withColumn("value", F.when(F.col("value").isNotNull(), F.raise_error(F.lit("unreadable"))).cast("double"))
    try:
        run_job(spark, "revenue_recon", bad, base, "r0", roles=EVENT_ROLES)
    except Exception as error:
        if "unreadable" not in str(error):
            raise
    checked = check_manifests(spark, base, "revenue_reconciliation", "r0").select("job_name", "run_id", "actual_rows", "ok")
    manifests = read_manifests(spark, base).select(
        "job_name", "run_id", "input_record_count", "output_record_count", "status"
    )
    return manifests.join(checked, ["job_name", "run_id"])


def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of ``orders``, then of ``lineitem`` as the same run, then an attempt
    that was killed before its pointer: what readers see, and the check."""
    base = scratch_path(spark, "runs")
    run_job(spark, "revenue_recon", table(spark, sf_dir, "orders"), base, "r0", roles=ORDER_ROLES)
    run_job(spark, "revenue_recon", table(spark, sf_dir, "lineitem"), base, "r0", roles=LINEITEM_ROLES)
    run_dir = f"{base}/{JOBS['revenue_recon'].job_name}/r0"
    write_result(revenue_total(spark, sf_dir), attempt_of(run_dir), single_file=True)
    result = read_result(spark, run_dir, JOBS["revenue_recon"].schema).withColumn("run_id", F.lit("r0"))
    left = leftovers(spark, base).groupBy("run_id").agg(F.count(F.lit(1)).alias("killed_attempts"))
    checked = check_manifests(spark, base).select("run_id", "actual_rows", "ok")
    return result.join(checked, "run_id").join(left, "run_id")


def part_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's comment line, with line breaks and quotes put in, published
    in many parts: rows recorded and found by part, per key."""
    orders = table(spark, sf_dir, "orders")
    text = F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"\n\\"'), F.col("o_orderpriority"), F.lit("\\\n,"))
    lines = orders.select(F.when(F.col("o_orderkey") % 3 > 0, text).alias("line"), "o_orderkey")
    base = scratch_path(spark, "runs")
    attempt = attempt_of(f"{base}/lines/r0")
    parts = write_parts(lines.repartition(7, "o_orderkey"), attempt)
    write_part_statistics(spark, parts, attempt)
    publish(spark, attempt)
    return (
        check_parts(spark, base)
        .groupBy("job_name", "run_id")
        .agg(
            F.sum("rows").alias("recorded_rows"),
            F.sum("found_rows").alias("found_rows"),
            F.min((F.col("bytes") == F.col("found_bytes")).cast("int")).alias("same_bytes"),
            F.min(F.col("ok").cast("int")).alias("ok"),
        )
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top spend written as one headerless CSV part, read back with its schema."""
    result = top_spend(spark, sf_dir)
    path = scratch_path(spark, "csv-roundtrip")
    write_result(result, path, single_file=True)
    return read_result(spark, path, result.schema)


def _run_top_callers(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "runs")
    orders_path = f"{sf_dir.rstrip('/')}/orders.parquet"
    run_job(spark, "top_callers", lambda: spark.read.parquet(orders_path), base, "r0", orders_path, ORDER_ROLES)
    return base


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_top_callers(spark, sf_dir)
    return read_manifests(spark, base).select(
        "job_name", "run_id", "input_record_count", "output_record_count", "status"
    )


def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_manifests(spark, _run_top_callers(spark, sf_dir))


def key_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("caller_id"))
    return key_bucket_op(ev, "caller_id")


def key_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows placed by ``repartition_by_key``, with the partition each landed in."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("caller_id"))
    placed = repartition_by_key(key_bucket_op(ev, "caller_id"), "caller_id")
    return placed.withColumn("partition", F.spark_partition_id())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_spend": top_spend,
    "top_spend_lineitem": top_spend_lineitem,
    "usage_heatmap": usage_heatmap,
    "outlier_events": outlier_events,
    "outlier_events_split": outlier_events_split,
    "outlier_events_shuffle": outlier_events_shuffle,
    "revenue_total": revenue_total,
    "revenue_lineitem": revenue_lineitem,
    "heavy_hitters": heavy_hitters_q,
    "heavy_hitters_sketch": heavy_hitters_sketch,
    "group_stats": group_stats_q,
    "heavy_group_stats": heavy_group_stats_q,
    "stats_lookup": stats_lookup,
    "parsed_hour": parsed_hour,
    "parsed_heatmap": parsed_heatmap,
    "typed_projection": typed_projection,
    "input_rowcount": input_rowcount,
    "csv_roundtrip": csv_roundtrip,
    "csv_null_keys": csv_null_keys,
    "failed_run": failed_run,
    "published_versions": published_versions,
    "part_check": part_check,
    "rejected_rows": rejected_rows,
    "revenue_fractional": revenue_fractional,
    "top_spend_fractional": top_spend_fractional,
    "run_manifest": run_manifest,
    "manifest_check": manifest_check,
    "key_bucket": key_bucket,
    "key_partition": key_partition,
    "key_spread": key_spread,
    **CDR_QUERIES,
}
