"""Schemas and column roles.

The input is a flat table of call detail records (CDRs). Every operator takes
column names as arguments, so the same code runs on the CDR CSV and on any other
table whose columns play the same roles (see ``Roles``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Input layout of the CDR CSV, header line included. Declared, never inferred:
# inference costs a full extra pass and makes the types depend on the data.
CDR_SCHEMA = T.StructType(
    [
        T.StructField("caller_id", T.StringType(), True),
        T.StructField("receiver_id", T.StringType(), True),
        T.StructField("duration_sec", T.DoubleType(), True),
        T.StructField("tower_id", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("call_type", T.StringType(), True),
        T.StructField("charge_amount", T.DoubleType(), True),
    ]
)

# Result layouts, in the column order the jobs write them (headerless CSV).
TOP_CALLERS_SCHEMA = T.StructType(
    [
        T.StructField("caller_id", T.StringType(), True),
        T.StructField("total_spend", T.DoubleType(), True),
    ]
)

HEATMAP_SCHEMA = T.StructType(
    [
        T.StructField("tower_id", T.StringType(), True),
        T.StructField("hour_of_day", T.IntegerType(), True),
        T.StructField("call_count", T.LongType(), True),
    ]
)

ANOMALY_SCHEMA = T.StructType(
    [
        T.StructField("caller_id", T.StringType(), True),
        T.StructField("call_timestamp", T.StringType(), True),
        T.StructField("duration_sec", T.LongType(), True),
        T.StructField("user_mean_duration", T.DoubleType(), True),
        T.StructField("user_stddev", T.DoubleType(), True),
    ]
)

REVENUE_SCHEMA = T.StructType([T.StructField("total_revenue", T.DoubleType(), True)])

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType(), True),
        T.StructField("run_id", T.StringType(), True),
        T.StructField("execution_timestamp_utc", T.StringType(), True),
        T.StructField("input_path", T.StringType(), True),
        T.StructField("output_path", T.StringType(), True),
        T.StructField("input_record_count", T.LongType(), True),
        T.StructField("output_record_count", T.LongType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)


# The jobs' defaults. Top callers keeps 100 callers; a caller
# with more than 50000 calls is heavy (strict >); a call is an anomaly beyond
# 3 sample standard deviations from its caller's mean.
TOP_N = 100
HEAVY_THRESHOLD = 50_000
SIGMAS = 3.0


@dataclass(frozen=True)
class Roles:
    """Which input column plays which CDR role."""

    caller: str = "caller_id"
    duration: str = "duration_sec"
    tower: str = "tower_id"
    timestamp: str = "timestamp"
    charge: str = "charge_amount"


CDR_ROLES = Roles()
