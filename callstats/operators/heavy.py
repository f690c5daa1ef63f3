"""Heavy keys without a shuffle of the light ones.

A first pass counts rows per hash of the key, in a fixed number of cells: one
row of a count-min sketch, built by a grouped count whose partial results are
at most as many as the cells. A cell's count is never below that of a key in it,
so keys of cells at or under the threshold are light for certain. A second pass
counts the keys of the other cells exactly. The light keys that share a cell
with heavy ones are the only others that are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstats.operators.aggregates import heavy_hitters
from callstats.operators.lookup import DEFAULT_BROADCAST_ROWS, sized_lookup

#: Cells of the sketch. With N rows at most N / threshold cells can be heavy by
#: heavy keys alone, so thresholds well above N / CELLS keep most rows out.
CELLS = 1 << 20


def cell_of(key: str, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(cells))


def candidate_rows(
    df: DataFrame, key: str, threshold: int, cells: int = CELLS, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """The ``key`` of the rows whose cell has more than ``threshold`` rows: all rows of
    heavy keys, and of the light keys that share a cell with them."""
    slim = df.select(key)
    counts = slim.groupBy(cell_of(key, cells).alias("_cell")).agg(F.count(F.lit(1)).alias("_rows"))
    heavy, _ = sized_lookup(counts.where(F.col("_rows") > F.lit(int(threshold))).select("_cell"), max_broadcast_rows)
    return slim.withColumn("_cell", cell_of(key, cells)).join(heavy, "_cell", "left_semi").select(key)


def heavy_hitters_sketched(
    df: DataFrame,
    key: str,
    threshold: int,
    out: str = "n",
    cells: int = CELLS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``heavy_hitters``, exact as well, by a sketch and a recount of its candidates.

    Reads ``key`` twice. Worth it where keys are many and heavy ones few: the
    shuffle is bounded by ``cells`` per task instead of by the keys.
    """
    return heavy_hitters(candidate_rows(df, key, threshold, cells, max_broadcast_rows), key, threshold, out)
