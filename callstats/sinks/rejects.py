"""Quarantine: the input rows that a run could not use, kept beside its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callstats.sinks.manifest import found_or_empty
from callstats.sinks.publish import current

# Fixed value: the folder of rejected rows inside an attempt's; the underscore
# hides it from readers of the result.
REJECTS_DIR = "_REJECTED"
#: Column with the raw text of a CSV line in which a cell did not fit its type.
RAW_LINE = "_raw_line"


def write_rejects(rows: DataFrame, attempt_dir: str) -> None:
    """Write ``rows`` with all their columns as JSON lines, in parallel."""
    rows.write.json(f"{attempt_dir.rstrip('/')}/{REJECTS_DIR}")


def read_rejects(spark: SparkSession, run_dir: str, schema: T.StructType | str) -> DataFrame:
    """The rejected rows of a run's published result; empty if it kept none."""
    folder = f"{current(spark, run_dir) or run_dir.rstrip('/')}/{REJECTS_DIR}"
    return found_or_empty(spark, lambda: spark.read.schema(schema).json(folder), schema)
