"""Result sink: headerless CSV at the final URI, row count observed on the way."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callstats.sinks.publish import _path
from callstats.sources.cdr import null_text, read_result

#: Partitions whose row counts are told apart exactly; beyond it the parts of a
#: result are counted by one pass over it.
COUNTED_PARTS = 20_000


def write_result(df: DataFrame, uri: str, single_file: bool | str = False) -> int:
    """Write ``df`` as headerless CSV to ``uri`` (replacing it) and return its row count.

    The count is an ``observe`` metric of the write itself: no cache and no
    second job. It is attached last, so it sits in the result stage, whose
    metric updates Spark applies once per partition even when tasks or stages
    are re-run after an executor loss. ``single_file`` gathers the rows into
    one part file with a ``repartition(1)``, which keeps everything upstream
    parallel (a bare ``coalesce(1)`` would pull the last stage into one
    task); use it for bounded results only. ``single_file="coalesce"`` is for
    a frame that is one partition already (a top-k, a global aggregate): no
    extra exchange.
    """
    return sum(p["rows"] for p in write_parts(df, uri, single_file))


def write_parts(df: DataFrame, uri: str, single_file: bool | str = False) -> list[dict]:
    """``write_result``, returning ``part``, ``rows`` and ``bytes`` of every part
    file that has rows.

    The rows of a part are observed by the write itself, as an exact histogram
    over the partition numbers, which Spark's file names carry. The bytes come
    from listing the folder.
    """
    obs = Observation("result_rows")
    if single_file == "coalesce":
        out = df.coalesce(1)
    elif single_file:
        out = df.repartition(1)
    else:
        out = df
    # Observed metrics must not call spark_partition_id themselves.
    out = out.withColumn("_partition", F.spark_partition_id()).observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.histogram_numeric("_partition", F.lit(COUNTED_PARTS)).alias("parts"),
    )
    (
        out.drop("_partition")
        .write.mode("overwrite")
        .option("header", False)
        .option("nullValue", null_text(df.schema))
        .csv(uri)
    )
    spark = df.sparkSession
    files = part_files(spark, uri)
    seen = reached(obs)
    if seen is None:  # metrics node planned away (empty input): count what was written
        rows = read_result(spark, uri, df.schema).groupBy(F.col("_metadata.file_name").alias("part")).count().collect()
        counts = {part_number(r["part"]): r["count"] for r in rows}
    else:
        counts = {int(b["x"]): int(b["y"]) for b in seen["parts"] or []}
        if sum(counts.values()) != seen["rows"] or len(counts) >= COUNTED_PARTS:
            rows = count_records(spark, f"{uri.rstrip('/')}/part-*").collect()
            counts = {part_number(r["file"]): r["records"] for r in rows}
    return [{"part": name, "rows": counts.get(part_number(name), 0), "bytes": size} for name, size in files]


def reached(obs: Observation) -> dict | None:
    """What ``obs`` has observed, or None where no finished job held it; does
    not wait. A job that failed leaves what it had observed by then."""
    if obs._jo is None or not obs._jo.future().isCompleted():
        return None
    found = obs.get
    return found or None


def part_number(name: str) -> int:
    return int(re.search(r"part-(\d+)", name).group(1))


def part_files(spark: SparkSession, uri: str) -> list[tuple[str, int]]:
    """Names and bytes of the part files with content."""
    fs, path = _path(spark, uri)
    found = ((s.getPath().getName(), s.getLen()) for s in fs.listStatus(path))
    return sorted((name, size) for name, size in found if name.startswith("part-") and size)


def count_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file`` and ``records`` of headerless result CSVs, whose texts may hold
    line breaks, by reading lines: files are split between tasks as usual.

    A line break ends a record if the quotes before it in the file are even. A
    task does not know its start, so it counts for both cases and whether its
    own quotes are odd; a file's splits are then put together in order.
    """
    import numpy as np
    import pyarrow as pa

    # Escaped quotes and backslashes aside, what is left of quotes is syntax.
    quotes = F.length(F.regexp_replace("value", r'\\["\\]|[^"\\]|\\(?!["\\])', ""))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (quotes % 2).cast("byte").alias("odd"),
    )

    def run(batches):
        held = None  # file, start, quotes odd so far, records if begun outside, if begun inside

        def row():
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(held, kinds)], names=names)

        for b in batches:
            files = b.column(0).dictionary_encode()
            code, start, odd = files.indices.to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()
            if not len(odd):
                continue
            new = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (start[1:] != start[:-1])])
            for a, z in zip(new, [*new[1:], len(odd)]):
                key = (files.dictionary[int(code[a])].as_py(), int(start[a]))
                inside = np.cumsum(odd[a:z].astype(np.int64)) % 2
                flips, closed = int(inside[-1]), int((inside == 0).sum())
                counts = (closed, int(z - a) - closed)
                if held and held[:2] == key:
                    was = held[2]
                    held = (*key, was ^ flips, held[3] + counts[was], held[4] + counts[1 - was])
                else:
                    if held:
                        yield row()
                    held = (*key, flips, *counts)
        if held:
            yield row()

    names = ["file", "start", "odd", "outside", "inside"]
    splits = lines.mapInArrow(run, "file string, start long, odd long, outside long, inside long")
    folded = F.aggregate(
        F.sort_array(F.collect_list(F.struct(*names[1:]))),
        F.struct(F.lit(0).cast("long").alias("odd"), F.lit(0).cast("long").alias("records")),
        lambda acc, s: F.struct(
            acc["odd"].bitwiseXOR(s["odd"]).alias("odd"),
            (acc["records"] + F.when(acc["odd"] == 0, s["outside"]).otherwise(s["inside"])).alias("records"),
        ),
    )
    return splits.groupBy("file").agg(folded["records"].alias("records"))
