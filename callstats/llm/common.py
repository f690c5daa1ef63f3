"""Helpers shared by the operators: text batches, row numbers, bounded samples."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from callstats.operators.materialize import materialize


def map_texts(
    df: DataFrame,
    keep: list[str],
    text: str,
    fn: Callable[[list[str]], list[pa.Array]] | Callable[[list[bytes]], list[pa.Array]],
    fields: list[StructField],
    as_bytes: bool = False,
) -> DataFrame:
    """One row per input row: columns ``keep`` unchanged, then ``fields`` from
    ``fn``, which gets the batch's texts (NULL as empty) and returns one Arrow
    array per field. Only ``keep`` and ``text`` are read from ``df``.

    ``as_bytes`` gives ``fn`` the bytes of the texts, which need not be valid
    UTF-8; without it such a text fails the job."""
    whole = F.coalesce(F.col(text), F.lit(""))
    slim = df.select(*keep, (whole.cast("binary") if as_bytes else whole).alias("_text"))
    schema = StructType([slim.schema[c] for c in keep] + list(fields))
    names, n = schema.names, len(keep)

    def run(batches):
        for b in batches:
            out = fn(b.column(n).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + out, names=names)

    return slim.mapInArrow(run, schema)


def ordered(df: DataFrame, order: list[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` sorted globally by ``order`` and stored in the shared checkpoint
    folder, so its partitions and their row order are fixed from here on.

    Rows that tie on ``order`` are spread by their place in the input, so a key
    held by a third of the rows is split over many partitions.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    keys = [*order, "_place"]
    return materialize(placed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_place"))


def with_place(stored: DataFrame) -> DataFrame:
    """Partition number ``_part`` and row number in it ``_at`` of a stored frame."""
    m = F.monotonically_increasing_id()
    return (
        stored.withColumn("_m", m)
        .withColumn("_part", F.shiftright("_m", 33).cast("int"))
        .withColumn("_at", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_m")
    )


def file_place() -> tuple[Column, Column]:
    """File and row-in-file of a frame read from Parquet files. The file's part
    number comes first, so files written by an ordered write sort as written."""
    path = F.col("_metadata.file_path")
    number = F.coalesce(F.try_to_number(F.regexp_extract(path, r"part-(\d{1,9})", 1), F.lit("999999999")), F.lit(0))
    return F.struct(number.cast("long").alias("number"), path.alias("path")), F.col("_metadata.row_index")


def class_sample(
    labelled: DataFrame, label: str, key: str, per_class: int, salt: int = 0
) -> DataFrame:
    """At most ``per_class`` rows for each value 0 and 1 of ``label``, chosen by
    a hash of ``key``: the same rows for the same input, whatever its layout."""
    one = [
        labelled.where(F.col(label) == v).orderBy(F.xxhash64(F.col(key), F.lit(salt)), key).limit(per_class)
        for v in (0, 1)
    ]
    return one[0].unionByName(one[1])
