"""Reproducible shuffle into shards: a Feistel permutation over row numbers.

Each row gets a global row number, the permutation moves it to another number
below the row count, and ``shard = number mod shards``, ``slot = number div
shards``. So shard and slot of any row can be computed without data movement,
shard counts differ by at most one, and slots have no gaps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstats.llm.common import file_place, ordered, with_place

ROUNDS = 4
#: Key of the production shuffle.
SEED = 20240501


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply) of ``x`` under a round key."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def round_keys(seed: int) -> list[int]:
    """The 64-bit key of each round."""
    return [(seed * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF for r in range(ROUNDS)]


def feistel(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Permutation of 0..n-1 applied to ``numbers`` (or its inverse).

    A balanced Feistel network permutes the next even power of two; numbers
    that land at or beyond ``n`` walk on along their cycle until they are back
    below it, which keeps the map one to one.
    """
    if n <= 1:
        return numbers.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = round_keys(seed)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & low
        if inverse:
            for key in reversed(keys):
                left, right = right ^ (_mix(left, key) & low), left
        else:
            for key in keys:
                left, right = right, left ^ (_mix(right, key) & low)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def permute(numbers: np.ndarray, n: int, seed: int, window: int | None = None) -> np.ndarray:
    """``feistel`` over all of 0..n-1, or over each run of ``window`` numbers by
    itself (the last one may be shorter): a number then stays in its window."""
    if window is None or window >= n:
        return feistel(numbers, n, seed)
    base = numbers // window * window
    out, last = np.empty(len(numbers), np.int64), base + window > n
    out[~last] = feistel((numbers - base)[~last], window, seed)
    out[last] = feistel((numbers - base)[last], n % window, seed)
    return base + out


def permuted(number: Column, n: int, seed: int, window: int | None = None) -> Column:
    """The Feistel permutation as a column expression (vectorised in numpy)."""

    @F.pandas_udf("long")
    def moved(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, seed, window))

    return moved(number)


def place(
    numbered: DataFrame, n: int, shards: int, seed: int, number: str = "row_number", window: int | None = None
) -> DataFrame:
    """``shard`` and ``slot`` of rows that carry their global number. With
    ``window`` rows keep their order coarsely: a shard's slots pass through the
    windows one after the other, and each window is shuffled over all shards."""
    p = F.col("_moved")
    return (
        numbered.withColumn("_moved", permuted(F.col(number), n, seed, window))
        .withColumn("shard", (p % shards).cast("int"))
        .withColumn("slot", F.floor(p / F.lit(shards)).cast("long"))
        .drop("_moved")
    )


def number_sorted(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``row_number`` 0..n-1 in the global order ``order``, and n. Only one row
    per partition is gathered, for the partitions' offsets."""
    stored = with_place(ordered(df, order))
    counts = {r["_part"]: r["count"] for r in stored.groupBy("_part").count().collect()}
    return _offset(stored, "_part", counts)


def number_in_files(df: DataFrame) -> tuple[DataFrame, int]:
    """``row_number`` of a frame read from Parquet, in file order, and the row
    count. Moves no rows: one row per file is gathered for the offsets."""
    file, at = file_place()
    placed = df.withColumns({"_file": file, "_at": at})
    counts = {r["_file"]: r["count"] for r in placed.groupBy("_file").count().collect()}
    return _offset(placed, "_file", counts)


def _offset(placed: DataFrame, part: str, counts: dict) -> tuple[DataFrame, int]:
    start, offsets = 0, []
    for key in sorted(counts):
        offsets.append((key, start))
        start += counts[key]
    schema = f"{part} {placed.schema[part].dataType.simpleString()}, _start long"
    table = placed.sparkSession.createDataFrame(offsets, schema)
    # One row per partition or file: the driver listed them all already.
    joined = placed.join(F.broadcast(table), part)
    return joined.withColumn("row_number", F.col("_start") + F.col("_at")).drop("_start", "_at", part), start


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """Shard, slot, size and checksum of every document, without its text.

    Row numbers follow doc_id, then size, checksum and a 64-bit hash of the
    text; rows equal in all of these are interchangeable. NULL doc_ids come
    first; a NULL text has no bytes (size 1, checksum 0). No rows: no rows.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_hash"),
    )
    numbered, n = number_sorted(slim, ["doc_id", "size", "text_crc32", "_hash"])
    return place(numbered, n, shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
