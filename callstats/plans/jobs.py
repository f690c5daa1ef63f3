"""The four batch jobs and the run wrapper (result + manifest).

Each job is a pure function ``DataFrame -> DataFrame`` over columns named by a
``Roles`` mapping; only ``run_job`` / ``run`` start Spark jobs.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.functions.rounding import round_exact
from callstats.functions.time import as_text, as_timestamp, hour_of_day
from callstats.operators.aggregates import count_rows, observe_rows_seen, top_by_sum, total
from callstats.operators.outliers import zscore_outliers
from callstats.operators.projection import conform
from callstats.schema import (
    ANOMALY_SCHEMA,
    CDR_ROLES,
    HEATMAP_SCHEMA,
    HEAVY_THRESHOLD,
    REVENUE_SCHEMA,
    SIGMAS,
    TOP_CALLERS_SCHEMA,
    TOP_N,
    Roles,
)
from callstats.sinks.manifest import manifest_record, write_manifest, write_part_statistics
from callstats.sinks.publish import attempt_of, discard, publish, retire
from callstats.sinks.rejects import RAW_LINE, write_rejects
from callstats.sinks.results import reached, write_parts
from callstats.sources.cdr import read_cdr, read_table


def top_callers(
    df: DataFrame, roles: Roles = CDR_ROLES, n: int = TOP_N, input_rows: Observation | None = None
) -> DataFrame:
    """``caller_id, total_spend``: the ``n`` callers with the largest exact spend.

    ``input_rows`` (every job takes it) receives the input row count, taken in
    the job's own pass over the input; see ``run_job``.
    """
    return top_by_sum(
        df, roles.caller, roles.charge, n=n, out_key="caller_id", out_value="total_spend", input_rows=input_rows
    )


def with_hour(df: DataFrame, roles: Roles = CDR_ROLES) -> DataFrame:
    """``df`` plus ``hour_of_day`` (UTC); NULL where the timestamp does not parse."""
    ts_type = df.schema[roles.timestamp].dataType
    return df.withColumn("hour_of_day", hour_of_day(as_timestamp(ts_type, roles.timestamp)))


def tower_heatmap(df: DataFrame, roles: Roles = CDR_ROLES, input_rows: Observation | None = None) -> DataFrame:
    """``tower_id, hour_of_day, call_count``; rows without a valid time are dropped.

    Rows are counted by ``count(hour_of_day)``, which skips NULL hours, so the
    only group that can count 0 is the unparseable one and it is dropped after
    the aggregate. A NULL filter before the aggregate would be pushed below
    the projection and parse every timestamp twice.

    With ``input_rows`` the groups (at most towers x 25) are gathered into one
    partition after the parallel final aggregate, and the input count is the
    sum of their row counts, unparseable group included, observed there.
    """
    hours = with_hour(df.select(roles.tower, roles.timestamp), roles)
    aggs = [F.count("hour_of_day").alias("call_count")]
    if input_rows is not None:
        aggs += count_rows("hour_of_day")
    counts = hours.groupBy(roles.tower, "hour_of_day").agg(*aggs)
    if input_rows is not None:
        counts = observe_rows_seen(counts.repartition(1), input_rows)
    return counts.where(F.col("call_count") > 0).select(
        F.col(roles.tower).alias("tower_id"), "hour_of_day", "call_count"
    )


def anomalous_calls(
    df: DataFrame,
    roles: Roles = CDR_ROLES,
    k: float = SIGMAS,
    strategy: str = "auto",
    heavy_threshold: int = HEAVY_THRESHOLD,
    input_rows: Observation | None = None,
    **options,
) -> DataFrame:
    """``caller_id, call_timestamp, duration_sec, user_mean_duration, user_stddev``:
    calls more than ``k`` sample stddevs from the caller's mean duration, with
    the caller's mean and stddev rounded to 2 places as Python's ``round``
    does (``round_exact``).
    """
    ts_type = df.schema[roles.timestamp].dataType
    hits = zscore_outliers(
        df,
        roles.caller,
        roles.duration,
        keep=[roles.timestamp],
        k=k,
        strategy=strategy,
        heavy_threshold=heavy_threshold,
        input_rows=input_rows,
        out_mean="_mean",
        out_stddev="_stddev",
        **options,
    )
    return hits.select(
        F.col(roles.caller).alias("caller_id"),
        as_text(ts_type, roles.timestamp).alias("call_timestamp"),
        F.col(roles.duration).alias("duration_sec"),
        round_exact("_mean", 2).alias("user_mean_duration"),
        round_exact("_stddev", 2).alias("user_stddev"),
    )


def revenue_recon(df: DataFrame, roles: Roles = CDR_ROLES, input_rows: Observation | None = None) -> DataFrame:
    """``total_revenue``: one row, the exact sum of all charges (NULL if none)."""
    return total(df, roles.charge, "total_revenue", input_rows=input_rows)


def _no_charge(df: DataFrame, roles: Roles) -> Column:
    return F.col(roles.charge).isNull()


def _no_hour(df: DataFrame, roles: Roles) -> Column:
    return hour_of_day(as_timestamp(df.schema[roles.timestamp].dataType, roles.timestamp)).isNull()


def _no_duration(df: DataFrame, roles: Roles) -> Column:
    return F.col(roles.caller).isNull() | F.col(roles.duration).isNull()


@dataclass(frozen=True)
class Job:
    job_name: str
    build: Callable[..., DataFrame]
    # How the result becomes one part file: None (written in parallel),
    # "coalesce" (the result is one partition already: top-k, global sum) or
    # "repartition" (gathered after a parallel last stage). One part file is
    # only right for results with a size bound. With ``input_rows`` the
    # single-file builders return one partition themselves.
    one_file: str | None
    # Layout of the published CSV: column order and types.
    schema: T.StructType
    # Which input rows the job cannot use: those of ``rejected_record_count``.
    rejects: Callable[[DataFrame, Roles], Column]

    @property
    def single_file(self) -> bool:
        return self.one_file is not None


# Logical query names and the job names used in output paths.
JOBS: dict[str, Job] = {
    "top_callers": Job("top_callers_by_spend", top_callers, "coalesce", TOP_CALLERS_SCHEMA, _no_charge),
    "tower_heatmap": Job("tower_utilization_heatmap", tower_heatmap, "repartition", HEATMAP_SCHEMA, _no_hour),
    "anomalous_calls": Job("anomalous_call_detection", anomalous_calls, None, ANOMALY_SCHEMA, _no_duration),
    "revenue_recon": Job("revenue_reconciliation", revenue_recon, "coalesce", REVENUE_SCHEMA, _no_charge),
}

INPUT_COUNTS = ("exact", "action", "none")


def observed_rows(obs: Observation, source: DataFrame) -> tuple[int, int | None]:
    """Row count observed on ``source`` during the job, and how many of the rows
    were rejected: no valid time, number or key where the job needs one.

    When AQE finds an empty shuffle it drops the plan below it, metrics node
    included; only then is the (empty or tiny) input counted directly.
    """
    seen = reached(obs)
    if seen is not None and seen["rows"] is not None:
        return int(seen["rows"]), int(seen["rejected"])
    n = source.count()
    return n, None if n else 0


def counted_after_failure(source: DataFrame | None) -> int:
    """Input rows of a run that failed before its pass over the input was done:
    what was observed by then is a part of them. The input is counted without the
    columns that may have failed; 0 if it cannot be opened."""
    try:
        return source.count() if source is not None else 0
    except (PySparkException, Py4JError):  # the run's own error is the one to report
        return 0


def resolve_run_id(run_id: str | None) -> str:
    """The run id, or a UTC fallback when it is missing, blank or ``none``."""
    if run_id is None or not run_id.strip() or run_id.strip().lower() == "none":
        return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_fallback")
    return run_id


def run_job(
    spark: SparkSession,
    name: str,
    df: DataFrame | Callable[[], DataFrame],
    output_base: str,
    run_id: str | None = None,
    input_path: str = "",
    roles: Roles = CDR_ROLES,
    input_count: str = "exact",
    keep_rejects: bool = False,
    **params,
) -> dict:
    """Run job ``name`` on ``df`` and publish the result of run
    ``{output_base}/{job_name}/{run_id}/`` with its manifest.

    ``df`` may be a function that opens the input, so that a missing input is
    reported like any other failure. The output row count is observed in the
    write's result stage. The input row count, by ``input_count``:

    - ``"exact"`` (default): taken in the job's own single pass over the
      input. Each job's aggregate carries per-group row counts, summed where
      Spark applies metric updates once per partition (a result stage), so
      the count stays exact when tasks are re-run after an executor loss.
    - ``"action"``: a separate ``count()`` first, as the reference does:
      nearly free on Parquet, a second full read on CSV.
    - ``"none"``: not counted (``input_record_count`` is null).

    The returned record is the manifest with ``rejected_record_count`` beside it:
    of the input rows those without a valid time, number or key where the job
    needs one (None unless ``input_count`` is ``"exact"``). So a column that does
    not parse is seen, although the run succeeds.

    With ``keep_rejects`` these rows are written, whole, beside the result
    (``sinks.rejects``): if the count found any, or is not known, they are
    filtered from the input in a pass of their own.

    Every attempt writes result, part statistics and manifest into a folder of
    its own under ``{output_base}/{job_name}/{run_id}/`` (``output_path``); one
    small pointer then makes it the run's result (``sinks.publish``). So a failed
    or killed run leaves an earlier result as it was. On failure the attempt's
    folder keeps a FAILURE manifest alone, with the input count
    (observed, or counted anew by ``counted_after_failure``; null with
    ``"none"``), and the error is re-raised.
    The session's time zone is UTC while the job runs; nothing depends on ANSI
    mode.
    """
    if input_count not in INPUT_COUNTS:
        raise ValueError(f"input_count must be one of {INPUT_COUNTS}")
    if name not in JOBS:
        raise KeyError(f"unknown job {name!r}; known: {sorted(JOBS)}")
    job = JOBS[name]
    run_id = resolve_run_id(run_id)
    run_dir = f"{output_base.rstrip('/')}/{job.job_name}/{run_id}"
    attempt = attempt_of(run_dir)
    rows_in = rejected = source = obs_in = None
    zone = spark.conf.get("spark.sql.session.timeZone")
    # Hours and times without a zone are UTC, whatever session runs the job.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        source = df() if callable(df) else df
        gather = job.one_file
        if input_count == "exact":
            obs_in = Observation("input_rows")
            result = job.build(source, roles, input_rows=obs_in, **params)
            # Jobs that store statistics first have read all of their input by now.
            seen = reached(obs_in)
            if seen is not None:
                rows_in, rejected = int(seen["rows"]), int(seen["rejected"])
            gather = "coalesce" if job.single_file else None
        else:
            if input_count == "action":
                rows_in = source.count()
            result = job.build(source, roles, **params)
        # Published in the job's fixed layout whatever the input types (a
        # projection in the same stage: the metrics stay where they are).
        parts = write_parts(conform(result, job.schema), attempt, single_file=gather or False)
        if input_count == "exact" and rows_in is None:
            rows_in, rejected = observed_rows(obs_in, source)
        output_count = sum(p["rows"] for p in parts)
        record = manifest_record(job.job_name, run_id, input_path, attempt + "/", rows_in, output_count, "SUCCESS")
        write_part_statistics(spark, parts, attempt)
        write_manifest(spark, record, attempt)
        if keep_rejects and rejected != 0:
            write_rejects(source.where(job.rejects(source, roles)), attempt)
        publish(spark, attempt)
    except Exception:
        if rows_in is None and input_count != "none":
            rows_in = counted_after_failure(source)
        record = manifest_record(job.job_name, run_id, input_path, attempt + "/", rows_in, 0, "FAILURE")
        try:
            discard(spark, attempt)
            write_manifest(spark, record, attempt)
        except (PySparkException, Py4JError):  # the original error matters more than the manifest's
            pass
        raise
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    retire(spark, run_dir)
    return record | {"rejected_record_count": rejected}


def run(
    spark: SparkSession,
    name: str,
    input_uri: str,
    output_base: str,
    run_id: str | None = None,
    fmt: str | None = None,
    roles: Roles = CDR_ROLES,
    by_header: bool = True,
    **params,
) -> dict:
    """Read ``input_uri`` (CDR CSV by default) and run job ``name`` on it.

    Without ``fmt`` the suffix decides: ``.parquet``, ``.json``, else CSV. CSV
    columns are matched by header name unless ``by_header=False`` (see
    ``read_cdr``). With ``keep_rejects`` the rejected rows of a CSV carry their
    raw line where a cell did not fit its type.
    """
    fmt = fmt or next((f for f in ("parquet", "json") if input_uri.rstrip("/").endswith(f".{f}")), "csv")
    raw = RAW_LINE if fmt == "csv" and params.get("keep_rejects") else None

    def source() -> DataFrame:
        if raw:
            return read_cdr(spark, input_uri, corrupt_column=raw, by_header=by_header)
        return read_table(spark, input_uri, fmt, by_header=by_header)

    return run_job(spark, name, source, output_base, run_id, input_path=input_uri, roles=roles, **params)
