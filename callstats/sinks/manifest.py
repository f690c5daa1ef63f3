"""Run manifests: one JSON record per attempt, next to the attempt's output, and
the check of runs against what they stored."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.schema import MANIFEST_SCHEMA
from callstats.sinks.publish import ATTEMPT, POINTERS, attempts, put
from callstats.sinks.results import count_records

# Fixed value: the manifest folder inside an attempt's. The leading underscore
# hides it from readers of the result files.
MANIFEST_DIR = "_MANIFEST"
#: Statistics of the attempt's part files, beside its manifest.
PARTS_DIR = "_PARTS"
#: Both are small, one file each, put by the driver.
ONE_FILE = "part-00000.json"
PARTS_SCHEMA = T.StructType().add("part", "string").add("rows", "long").add("bytes", "long")
RUN = ["job_name", "run_id"]


def utc_now_iso() -> str:
    """Current UTC time, ISO 8601 with microseconds and a ``Z`` suffix."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def manifest_record(
    job_name: str,
    run_id: str,
    input_path: str,
    output_path: str,
    input_count: int | None,
    output_count: int,
    status: str,
) -> dict:
    """One manifest; ``input_count`` is None where it is not known."""
    return {
        "job_name": job_name,
        "run_id": run_id,
        "execution_timestamp_utc": utc_now_iso(),
        "input_path": input_path,
        "output_path": output_path,
        "input_record_count": None if input_count is None else int(input_count),
        "output_record_count": int(output_count),
        "status": status,
    }


def write_manifest(spark: SparkSession, record: dict, attempt_dir: str) -> str:
    """Write one manifest record as JSON under ``attempt_dir``; return its path."""
    path = f"{attempt_dir.rstrip('/')}/{MANIFEST_DIR}"
    put(spark, f"{path}/{ONE_FILE}", json.dumps({f.name: record[f.name] for f in MANIFEST_SCHEMA.fields}) + "\n")
    return path


def write_part_statistics(spark: SparkSession, parts: list[dict], attempt_dir: str) -> None:
    """Write rows and bytes of every part file (``write_parts``) beside them."""
    lines = "".join(json.dumps(p) + "\n" for p in parts)
    put(spark, f"{attempt_dir.rstrip('/')}/{PARTS_DIR}/{ONE_FILE}", lines)


def _runs(output_base: str, job_name: str | None, run_id: str | None) -> str:
    return f"{output_base.rstrip('/')}/{job_name or '*'}/{run_id or '*'}"


def _split(path: Column, depth: int) -> list[Column]:
    """``job_name``, ``run_id`` and ``attempt`` of a path ``depth`` levels below
    its attempt's folder."""
    pieces = F.split(path, "/")
    names = [*RUN, "attempt"]
    return [F.url_decode(F.element_at(pieces, k - 2 - depth - 1)).alias(n) for k, n in enumerate(names)]


def found_or_empty(spark: SparkSession, reader: Callable[[], DataFrame], schema: T.StructType | str) -> DataFrame:
    """The frame of ``reader``, or an empty one where no file matches."""
    try:
        return reader()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _pointers(spark: SparkSession, runs: str) -> DataFrame:
    """``job_name``, ``run_id`` and ``name`` of every pointer, by listing."""
    files = spark.read.format("binaryFile")
    found = found_or_empty(spark, lambda: files.load(f"{runs}/{POINTERS}/*").select("path"), "path string")
    pieces = F.split("path", "/")
    return found.select(
        F.url_decode(F.element_at(pieces, -4)).alias("job_name"),
        F.url_decode(F.element_at(pieces, -3)).alias("run_id"),
        F.element_at(pieces, -1).alias("name"),
    )


def _published(spark: SparkSession, runs: str) -> DataFrame:
    """``job_name``, ``run_id`` and the published ``attempt`` of every run: the
    pointer with the highest version. Only names are read, no file's content."""
    # Version and attempt sort as the pointers' names do.
    pointer = F.struct(F.regexp_extract("name", r"^(\d+)~", 1).cast("long").alias("v"), F.substring_index("name", "~", -1).alias("a"))
    return _pointers(spark, runs).groupBy(*RUN).agg(F.max(pointer)["a"].alias("attempt"))


def _attempt_manifests(spark: SparkSession, runs: str) -> DataFrame:
    frame = spark.read.schema(MANIFEST_SCHEMA).json(f"{runs}/{ATTEMPT}*/{MANIFEST_DIR}")
    return frame.withColumn("attempt", _split(F.col("_metadata.file_path"), 2)[2])


def read_manifests(
    spark: SparkSession,
    output_base: str,
    job_name: str | None = None,
    run_id: str | None = None,
    history: bool = False,
) -> DataFrame:
    """Manifests under ``{output_base}/{job}/{run_id}/``: all, or those of one
    job, one run id or both.

    A run has the manifest of its published result and, beside it, a FAILURE
    manifest for each attempt that failed since. With ``history`` there are
    those of all attempts that left one, with the ``attempt``'s name.
    """
    runs = _runs(output_base, job_name, run_id)
    found = _attempt_manifests(spark, runs)
    return found if history else _standing(spark, runs, found).drop("attempt")


def _standing(spark: SparkSession, runs: str, found: DataFrame) -> DataFrame:
    published = _published(spark, runs).withColumnRenamed("attempt", "_published")
    failed = (F.col("status") == "FAILURE") & (F.col("_published").isNull() | (F.col("attempt") > F.col("_published")))
    return found.join(published, RUN, "left").where((F.col("attempt") == F.col("_published")) | failed).drop("_published")


def check_parts(
    spark: SparkSession, output_base: str, job_name: str | None = None, run_id: str | None = None
) -> DataFrame:
    """One row per part file of every published result, recorded or found:
    ``rows`` and ``bytes`` as recorded when it was written, ``found_rows`` and
    ``found_bytes``, and ``ok``: recorded, there, and the same.

    Bytes come from listing; rows from one pass that counts the records of lines
    and splits large files between tasks. Attempts that no pointer names are
    not looked at.
    """
    runs = _runs(output_base, job_name, run_id)
    published = _published(spark, runs)
    key = [*RUN, "attempt", "part"]
    files = f"{runs}/{ATTEMPT}*/part-*"
    place = "job_name string, run_id string, attempt string, part string"
    recorded = found_or_empty(
        spark,
        lambda: spark.read.schema(PARTS_SCHEMA)
        .json(f"{runs}/{ATTEMPT}*/{PARTS_DIR}")
        .select(*_split(F.col("_metadata.file_path"), 2), "part", "rows", "bytes"),
        f"{place}, rows long, bytes long",
    )
    sizes = found_or_empty(
        spark,
        lambda: spark.read.format("binaryFile")
        .load(files)
        .select(*_split(F.col("path"), 1), F.substring_index("path", "/", -1).alias("part"), F.col("length").alias("found_bytes")),
        f"{place}, found_bytes long",
    )
    counts = found_or_empty(
        spark,
        lambda: count_records(spark, files).select(
            *_split(F.col("file"), 1), F.substring_index("file", "/", -1).alias("part"), F.col("records").alias("found_rows")
        ),
        f"{place}, found_rows long",
    )
    there = sizes.join(counts, key, "left")
    both = recorded.join(there, key, "full_outer").join(published, [*RUN, "attempt"], "left_semi")
    same = (F.col("rows") == F.col("found_rows")) & (F.col("bytes") == F.col("found_bytes"))
    columns = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows", "bytes", "found_rows", "found_bytes")]
    return both.select(*key, *columns, F.coalesce(same, F.lit(False)).alias("ok"))


def check_manifests(
    spark: SparkSession, output_base: str, job_name: str | None = None, run_id: str | None = None
) -> DataFrame:
    """One row per run: the rows its published result should have, the rows
    stored there, and whether the last attempt succeeded and every part file has
    the rows and bytes recorded for it (``check_parts``).

    ``job_name`` and ``run_id`` go into the paths, so a check of one run reads
    that run only. A failed attempt leaves the counts of the standing result. An
    attempt that was killed is ignored here; ``leftovers`` names it.
    """
    runs = _runs(output_base, job_name, run_id)
    standing = _standing(spark, runs, _attempt_manifests(spark, runs))
    good = F.col("status") == "SUCCESS"
    states = standing.groupBy(*RUN).agg(
        F.max(F.when(good, F.col("output_record_count"))).alias("expected"), F.min(good).alias("good")
    )
    stored = (
        check_parts(spark, output_base, job_name, run_id)
        .groupBy(*RUN)
        .agg(F.sum("found_rows").alias("actual"), F.min("ok").alias("intact"))
    )
    expected, actual = (F.coalesce(c, F.lit(0)).cast("long") for c in ("expected", "actual"))
    ok = F.col("good") & (expected == actual) & F.coalesce("intact", F.lit(True))
    return states.join(stored, RUN, "left").select(
        *RUN, expected.alias("expected_rows"), actual.alias("actual_rows"), ok.alias("ok")
    )


def leftovers(
    spark: SparkSession, output_base: str, job_name: str | None = None, run_id: str | None = None
) -> DataFrame:
    """``job_name``, ``run_id`` and ``attempt`` of the attempts that were neither
    published nor recorded as failed: killed ones, and those still at work. The
    attempts' folders are listed, nothing in them is read but manifests."""
    runs = _runs(output_base, job_name, run_id)
    schema = "job_name string, run_id string, attempt string"
    all_of = spark.createDataFrame(attempts(spark, runs), schema)
    failed = found_or_empty(
        spark, lambda: _attempt_manifests(spark, runs).where("status = 'FAILURE'").select(*RUN, "attempt"), schema
    )
    pointed = _pointers(spark, runs).select(*RUN, F.substring_index("name", "~", -1).alias("attempt"))
    known = failed.unionByName(pointed)
    return all_of.join(known, [*RUN, "attempt"], "left_anti")
