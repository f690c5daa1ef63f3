"""Scalar column expressions (all JVM-side, codegen friendly)."""

from callstats.functions.hashing import crc32_bucket
from callstats.functions.money import exact_sum
from callstats.functions.rounding import round_exact
from callstats.functions.time import (
    CDR_TIME_FORMATS,
    ISO_MICROS,
    as_text,
    as_timestamp,
    hour_of_day,
    parse_timestamp,
)

__all__ = [
    "CDR_TIME_FORMATS",
    "ISO_MICROS",
    "as_text",
    "as_timestamp",
    "crc32_bucket",
    "exact_sum",
    "hour_of_day",
    "parse_timestamp",
    "round_exact",
]
