"""Incremental runs of the additive jobs as CDR files land in a folder.

The batch jobs are pure DataFrame functions, so the same code runs on a
streaming frame. Only jobs whose state stays per key work this way: the
heatmap (towers x 24 hours), revenue (one row) and top callers (one running
total per caller, top ``n`` re-ranked per micro-batch). Anomaly detection needs
every row against final statistics and stays a batch job.

Each micro-batch publishes the full current result as run
``{output_base}/{job_name}/{run_id}-b{batch_id}/`` with the batch result sink
and a manifest, so readers see complete, versioned snapshots. Stream state and
progress live in ``checkpoint`` (a shared folder), so a restarted query
resumes where it stopped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from callstats.operators.projection import conform
from callstats.plans.jobs import JOBS, resolve_run_id
from callstats.schema import CDR_ROLES, CDR_SCHEMA, Roles
from callstats.sinks.manifest import manifest_record, write_manifest, write_part_statistics
from callstats.sinks.publish import attempt_of, publish, retire
from callstats.sinks.results import write_parts
from callstats.sources.cdr import header_schema

STREAMABLE = ("top_callers", "tower_heatmap", "revenue_recon")


def read_cdr_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New CDR CSV files in ``folder`` as a stream, with the declared types.

    A stream needs its layout before it starts: it is taken from the header of
    the files already in ``folder`` (as the batch reader does), or is the
    declared order when there are none. Every file's header must match it; a
    file that does not fails the batch instead of being read into wrong
    columns.
    """
    try:
        schema = header_schema(spark, folder, CDR_SCHEMA)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = CDR_SCHEMA  # nothing to read yet
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def start_incremental(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    output_base: str,
    checkpoint: str,
    run_id: str | None = None,
    roles: Roles = CDR_ROLES,
    available_now: bool = True,
    input_path: str = "",
) -> StreamingQuery:
    """Start job ``name`` on the streaming frame ``source``.

    ``available_now=True`` processes what is in the folder, then stops (a
    scheduled incremental run); ``False`` keeps running.
    """
    if name not in STREAMABLE:
        raise ValueError(f"{name!r} is not incremental; streamable jobs: {STREAMABLE}")
    job = JOBS[name]
    run_id = resolve_run_id(run_id)
    result = job.build(source, roles)
    base = output_base.rstrip("/")

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        spark, run_dir = batch.sparkSession, f"{base}/{job.job_name}/{run_id}-b{batch_id}"
        attempt = attempt_of(run_dir)  # a replayed batch publishes a new version
        parts = write_parts(conform(batch, job.schema), attempt, single_file=job.single_file)
        rows = sum(p["rows"] for p in parts)
        # the stream's total input is not known inside a micro-batch
        record = manifest_record(job.job_name, f"{run_id}-b{batch_id}", input_path, attempt + "/", None, rows, "SUCCESS")
        write_part_statistics(spark, parts, attempt)
        write_manifest(spark, record, attempt)
        publish(spark, attempt)
        retire(spark, run_dir)

    writer = result.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(snapshot)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
