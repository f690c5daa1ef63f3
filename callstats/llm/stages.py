"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``docs``, whatever they are; a column of
``docs`` that has the name of one of an operator's results is left as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstats.llm import decontam, mixing, sharding, simhash, toxicity
from callstats.llm.common import file_place

#: Target weights of the mix. A source that is not named shares the stream "*".
WEIGHTS = {"src0": 10.0} | {f"src{k}": 6.0 for k in range(1, 6)} | {f"src{k}": 4.0 for k in range(6, 20)} | {"*": 4.0}
SHARDS = 16
#: Rows of one period of the mix.
WINDOW = mixing.PERIOD * mixing.BLOCK_ROWS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field predicts toxic go."""
    crf = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, crf)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest doc_id stays.

    Rows that repeat this doc_id in the group are repetitions of one document:
    one of them stays. In a group without any doc_id one of the rows stays.
    """
    file, at = file_place()
    placed = docs.select("doc_id", "text", file.alias("file"), at.alias("at"))
    found = simhash.near_duplicates(placed, keep=["doc_id", "file", "at"])
    # The smallest (doc_id, place) of a component, pre-aggregated before the shuffle.
    first = found.groupBy("component").agg(
        F.min_by(F.struct("file", "at"), F.struct(F.col("doc_id").isNull(), "doc_id", "file", "at")).alias("kept")
    )
    kept = first.select(F.col("kept.file").alias("_file"), F.col("kept.at").alias("_at"))
    rows = docs.withColumns({"_file_here": file, "_at_here": at})
    same = (F.col("_file_here") == F.col("_file")) & (F.col("_at_here") == F.col("_at"))
    return rows.join(kept, same, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, within its edit budget, go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the files are written in it, and
    the next stage numbers the rows by file and row."""
    file, at = file_place()
    slim = docs.select(file.alias("file"), at.alias("at"), F.col("source").alias("source"))
    placed = mixing.mix(slim, WEIGHTS, ["file", "at"]).select(
        F.col("file").alias("_file"), F.col("at").alias("_at"), F.col("position").alias("_position")
    )
    rows = docs.withColumns({"_file_here": file, "_at_here": at})
    same = (F.col("_file_here") == F.col("_file")) & (F.col("_at_here") == F.col("_at"))
    return rows.join(placed, same).orderBy("_position").select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot: the Feistel permutation of its
    row number in the mix, which is kept as ``row_number``.

    Rows are permuted within windows of one whole period of the mix, so a shard
    read slot by slot has the target weights in every window's stretch.
    """
    numbered, n = sharding.number_in_files(docs.select(F.struct(*docs.columns).alias("_row"), "_metadata"))
    placed = sharding.place(numbered, n, SHARDS, sharding.SEED, window=WINDOW)
    names = [c for c in docs.columns if c.lower() not in ("row_number", "shard", "slot")]
    return placed.select(*[F.col("_row")[c].alias(c) for c in names], "row_number", "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]
