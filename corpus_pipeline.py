"""From raw documents to shuffled training shards, in five stages.

Each stage is written as Parquet to the shared folder and read again by the
next. A stage that fails can be run again from its predecessor's output.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from callstats.llm.stages import STAGES  # noqa: E402
from callstats.session import scratch_path  # noqa: E402
from callstats.sinks.publish import discard  # noqa: E402

#: No SQL: a conditional random field, trained here, decides the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``.

    All columns of the documents are kept, whatever their names, but for those
    that the last stage adds. NULL texts are empty ones, texts of any length are
    judged whole, repeated rows are near duplicates of each other, and an empty
    table gives an empty result; each stage says the rest. A stage's input is
    deleted once its output stands; the last output is left for the reader.
    """
    docs, former = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if former is not None:
            discard(spark, former)
        former = path
    return docs
