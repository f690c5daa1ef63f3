"""Key placement: a fixed hash bucket per key and partitioning by it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callstats.functions.hashing import crc32_bucket
from callstats.operators.heavy import CELLS, heavy_hitters_sketched
from callstats.operators.lookup import DEFAULT_BROADCAST_ROWS, sized_lookup

# Fixed value: bucket count of the reference's custom partitioner.
DEFAULT_BUCKETS = 20


def key_bucket(df: DataFrame, key: str, n_buckets: int = DEFAULT_BUCKETS, out: str = "bucket") -> DataFrame:
    """``df`` with the key's CRC-32 bucket added as column ``out``."""
    return df.withColumn(out, crc32_bucket(key, n_buckets))


def repartition_by_key(df: DataFrame, key: str, n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Shuffle ``df`` so that partition ``i`` holds exactly the keys of bucket ``i``.

    Same placement as a CRC-32 custom partitioner, done by one exchange with
    ``repartitionById``. A hot key still lands in a single partition: use this
    where the placement itself is required, not for load balance
    (``spread_by_key``).
    """
    return df.repartitionById(n_buckets, crc32_bucket(key, n_buckets))


def heavy_layout(
    df: DataFrame,
    key: str,
    rows_per_part: int,
    n_buckets: int = DEFAULT_BUCKETS,
    cells: int = CELLS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> tuple[DataFrame, int]:
    """The second level of the placement, and the number of all partitions.

    One row per key with more than ``rows_per_part`` rows: the key, its ``_bucket``,
    ``_first`` partition and number of ``_parts``. The partitions after the
    ``n_buckets`` first belong to these keys, by bucket and key. There are fewer
    such keys than partitions of ``rows_per_part`` rows in the table.
    """
    heavy = heavy_hitters_sketched(df, key, rows_per_part, "_n", cells, max_broadcast_rows)
    parts = F.ceil(F.col("_n") / F.lit(rows_per_part)).cast("int")
    sized = heavy.select(key, crc32_bucket(key, n_buckets).alias("_bucket"), parts.alias("_parts"))
    so_far = F.sum("_parts").over(Window.orderBy("_bucket", F.col(key).asc_nulls_first()))
    layout, _ = sized_lookup(
        sized.withColumn("_first", (F.lit(n_buckets) + so_far - F.col("_parts")).cast("int")), max_broadcast_rows
    )
    total = layout.agg(F.coalesce(F.sum("_parts"), F.lit(0))).first()[0]
    return layout, n_buckets + int(total)


def spread_by_key(
    df: DataFrame,
    key: str,
    rows_per_part: int,
    n_buckets: int = DEFAULT_BUCKETS,
    cells: int = CELLS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Shuffle ``df`` by key in two levels: the key's bucket as in
    ``repartition_by_key``, and sub-buckets for a key that is too large for one
    partition.

    Partition ``i < n_buckets`` holds the keys of bucket ``i`` with up to
    ``rows_per_part`` rows. A larger key has partitions of its own
    (``heavy_layout``); a hash of their place in the input deals its rows out, so
    equal rows are spread as well. One exchange moves the rows; the heavy
    keys are found before by two passes over ``key`` alone.
    """
    layout, total = heavy_layout(df, key, rows_per_part, n_buckets, cells, max_broadcast_rows)
    heavy = layout.select(F.col(key).alias("_heavy"), "_first", "_parts")
    placed = df.withColumn("_place", F.monotonically_increasing_id()).join(
        heavy, F.col(key).eqNullSafe(F.col("_heavy")), "left"
    )
    sub = F.col("_first") + F.pmod(F.xxhash64("_place"), F.col("_parts")).cast("int")
    partition = F.coalesce(sub, crc32_bucket(key, n_buckets))
    return placed.repartitionById(total, partition).drop("_place", "_heavy", "_first", "_parts")
