"""Lineage cuts: a frame written to the shared checkpoint folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from callstats.session import shared_dir


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Metrics observed on ``df`` are collected by the checkpoint job's result
    stage, so they count each row once even when tasks are re-run.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
