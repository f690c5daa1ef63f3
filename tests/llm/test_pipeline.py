"""The pipeline's stages on the test tables and on odd documents."""

import pandas as pd
import pytest

import corpus_pipeline
from callstats.llm import decontam, simhash, stages
from callstats.llm.queries import ORACLE_SQL, QUERIES
from callstats.session import scratch_path
from tests.llm.test_exact_operators import empty_docs, odd_docs
from tests.oracle import duck, rows_of_duck, rows_of_spark

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    assert rows_of_spark(QUERIES[name](spark, SF)) == rows_of_duck(duck(SF), ORACLE_SQL[name])


def stored(spark, df):
    path = scratch_path(spark, "stage-test")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stored(spark, stage(spark, docs, SF))
        was, now = docs.toPandas(), after.toPandas()
        if name != "sharding":
            assert after.columns == docs.columns
        assert set(now["doc_id"]) <= set(was["doc_id"]) and now["doc_id"].is_unique
        if name == "near_duplicates":
            groups = simhash.near_duplicates(docs).toPandas()
            assert sorted(now["doc_id"]) == sorted(groups.loc[groups["doc_id"] == groups["component_id"], "doc_id"])
        if name == "decontamination":
            hits = decontam.contaminations(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).toPandas()
            assert set(now["doc_id"]) == set(was["doc_id"]) - set(hits["doc_id"]) and len(hits)
        if name in ("mixing", "sharding"):
            assert sorted(now["doc_id"]) == sorted(was["doc_id"])
        docs = after
    rows = docs.toPandas()
    assert sorted(rows["row_number"]) == list(range(len(rows)))
    sizes = rows.groupby("shard")["slot"].agg(["count", "max"])
    assert (sizes["count"] == sizes["max"] + 1).all() and sizes["count"].max() - sizes["count"].min() <= 1
    first = rows.sort_values("row_number")["source"].head(60).value_counts()
    assert first.max() <= 32  # blocks of several sources take turns


def test_shards_keep_the_mix(spark, monkeypatch):
    """A hot source with a third of all rows: every stretch of every shard has
    the target weights, not the proportions of the corpus."""
    monkeypatch.setattr(stages, "WINDOW", 1600)
    rows = [(k, "hot" if k % 3 == 0 else f"src{k % 4}") for k in range(12_000)]
    docs = stored(spark, spark.createDataFrame(rows, "doc_id long, source string"))
    mixed = stored(spark, stages.mix_sources(spark, docs, SF))
    got = stages.shard(spark, mixed, SF).toPandas()
    assert sorted(got["doc_id"]) == list(range(12_000)) and sorted(got["row_number"]) == list(range(12_000))
    sizes = got.groupby("shard")["slot"].agg(["count", "max"])
    assert (sizes["count"] == 750).all() and (sizes["max"] == 749).all()
    # The first window of a shard are the rows of the first window of the mix.
    early = got[got["slot"] < 100]
    assert early["row_number"].max() < 1600
    share = early["source"].eq("hot").mean()
    in_mix = got[got["row_number"] < 1600]["source"].eq("hot").mean()
    assert share == in_mix and abs(share - 1 / 3) > 0.1
    for _, of in early.groupby("shard"):
        assert abs(of["source"].eq("hot").mean() - share) < 0.15


def test_stages_on_odd_documents(spark, tmp_path):
    sf = str(tmp_path)
    pd.DataFrame({"doc_id": [3], "quality": [1], "toxic": [0]}).to_parquet(f"{sf}/labels.parquet")
    pd.DataFrame({"item_id": [1], "text": ["no such passage anywhere in these documents"]}).to_parquet(f"{sf}/benchmark.parquet")
    for docs in (odd_docs(spark), empty_docs(spark)):
        docs, kept = stored(spark, docs), None
        for name, stage in corpus_pipeline.STAGES:
            after = stored(spark, stage(spark, docs, sf))
            if name != "sharding":
                assert after.columns == docs.columns
            if name == "near_duplicates":
                kept = sorted((r["doc_id"] for r in after.collect()), key=str)
            docs = after
        got = docs.collect()
        assert sorted((r["doc_id"] for r in got), key=str) == kept
        if got:
            # One each of the empty texts, the equal texts and the others; the row without an id too.
            assert kept == sorted([0, 3, 4, 5, 6, 7, 9, None], key=str)
            assert {r["fp"] for r in got} == {"f", None}


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 100 and {"shard", "slot"} <= set(got.columns)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert stages.SHARDS == 16
