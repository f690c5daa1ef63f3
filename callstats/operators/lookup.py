"""Joins of a large row table to a small-or-large keyed lookup table.

The lookup side (per-key statistics, heavy keys) grows with the number of
distinct keys, so it is never broadcast blindly:

1. it is materialised once in the shared checkpoint folder (lineage cut, so a
   lost executor does not recompute the aggregate, and the scan gets its own
   shuffle exchange that AQE can split when one key is hot);
2. its row count and the bytes of its keys are checked;
3. it is broadcast only below both bounds; above them the join is a
   sort-merge join and AQE's skew-join handling splits any hot key on the row
   side into several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstats.operators.aggregates import heavy_group_stats
from callstats.operators.materialize import materialize

# Bounds of a broadcast lookup: rows, and bytes (64 a row and its texts').
DEFAULT_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20


def size_columns(df: DataFrame) -> list[Column]:
    """Aggregates ``rows`` and ``bytes`` (an upper estimate once hashed) of a lookup."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    text_bytes = sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts), F.lit(0))
    rows = F.count(F.lit(1))
    return [rows.alias("rows"), (rows * 64 + text_bytes).alias("bytes")]


def sided(small: DataFrame, rows: int, size: int, max_broadcast_rows: int) -> tuple[DataFrame, bool]:
    """``small`` marked for broadcast if both bounds hold, else for sort-merge,
    so that Spark's own size estimate cannot broadcast what the count ruled out."""
    fits = rows <= max_broadcast_rows and size <= MAX_BROADCAST_BYTES
    return (F.broadcast(small) if fits else small.hint("merge")), fits


def sized_lookup(lookup: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Materialise ``lookup`` and mark it for broadcast if it is small enough,
    by rows and by bytes. Returns the frame to join with and whether it was
    marked for broadcast."""
    small = materialize(lookup)
    found = small.agg(*size_columns(small)).first()
    return sided(small, found["rows"], found["bytes"], max_broadcast_rows)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``rows`` joined to ``lookup`` with a size-checked broadcast."""
    side, _ = sized_lookup(lookup, max_broadcast_rows)
    return rows.join(side, on, how)


def stats_lookup(
    df: DataFrame,
    key: str,
    value: str,
    threshold: int,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Every row with ``is_heavy`` (key has more than ``threshold`` rows) and
    the key's ``mean``/``stddev`` when heavy, 0.0 otherwise.
    """
    heavy = heavy_group_stats(df, key, value, threshold).select(
        key, F.lit(True).alias("_heavy"), F.col("mean").alias("_mean"), F.col("stddev").alias("_sd")
    )
    joined = lookup_join(df, heavy, key, "left", max_broadcast_rows)
    return joined.select(
        *[c for c in df.columns],
        F.coalesce(F.col("_heavy"), F.lit(False)).alias("is_heavy"),
        F.coalesce(F.col("_mean"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.col("_sd"), F.lit(0.0)).alias("stddev"),
    )
