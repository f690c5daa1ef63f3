"""Rounding that matches the reference's output values exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(col: str | Column, places: int) -> Column:
    """``col`` rounded to ``places`` decimals from its exact binary value, ties
    (exactly representable halves) to even: what Python's ``round(x, places)``
    gives.

    ``F.round`` instead rounds half up from the shortest decimal text of the
    double, so a mean stored as 2271.07499999... (printed 2271.075) becomes
    2271.08 there and 2271.07 here. ``format_number`` formats with the exact
    binary value and half-even ties, so its text, read back, is the Python
    result. NaN and infinities pass through.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = F.regexp_replace(F.format_number(c, places), ",", "")
    special = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(special, c).otherwise(text.cast("double"))
