"""Exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An amount is split into two limbs: whole units, and the rest in hundred-
# millionths of a unit. Both are whole numbers and are summed as doubles: exact,
# and so independent of the order partial sums arrive in, as long as a sum stays
# below 2^53. Beyond that a sum rounds like any double sum; nothing overflows.
CENTS_PER_UNIT = 100
FINE_PER_UNIT = 100_000_000
#: Larger amounts, NaN and infinities go to the first limb as they are.
LARGEST = 1e12
#: A double holds an amount to within this share of it; smaller remainders are
#: the representation's, not the amount's.
REPRESENTATION = 4.5e-16
#: Whole numbers up to here are exact.
EXACT = float(1 << 53)


def limbs(c: Column) -> tuple[Column, Column]:
    """Whole units of an amount and the rest in ``FINE_PER_UNIT``-ths: a whole
    number for amounts of up to eight decimals, in doubles' own accuracy."""
    plain, noise = F.abs(c) < F.lit(LARGEST), F.abs(c) * REPRESENTATION
    units, cents = F.rint(c), F.rint(c * CENTS_PER_UNIT)
    fine = (c - units) * float(FINE_PER_UNIT)
    # Of an amount in cents, the rest is exact however large the amount is.
    in_cents = F.abs(c * CENTS_PER_UNIT - cents) <= noise * CENTS_PER_UNIT
    exact = (cents - units * CENTS_PER_UNIT) * float(FINE_PER_UNIT // CENTS_PER_UNIT)
    other = F.when(F.abs(fine - F.rint(fine)) > noise * FINE_PER_UNIT, fine).otherwise(F.rint(fine))
    return F.when(plain, units).otherwise(c), F.when(plain, F.when(in_cents, exact).otherwise(other)).otherwise(0.0)


def exact_sum(col: str | Column) -> Column:
    """Sum of a money column, as the double nearest the exact decimal total.

    Amounts of up to eight decimals are summed exactly (see ``limbs``: totals up
    to 2^53 units), finer parts as doubles. As in a plain double sum, a NaN gives
    NaN and infinities stay infinite. A group without a value gives NULL. Nothing
    here depends on ANSI mode.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    units, fine = (F.sum(limb) for limb in limbs(c))
    # One rounding, of an exact decimal; sums past its range are doubles anyway.
    whole = (F.abs(units) < EXACT) & (F.abs(fine) < EXACT) & (F.rint(fine) == fine)
    tail = fine.try_cast("decimal(18,0)") * F.lit("0.00000001").cast("decimal(8,8)")
    exact = (units.try_cast("decimal(18,0)") + tail).cast("double")
    return F.when(whole, exact).otherwise(units + fine / float(FINE_PER_UNIT))
