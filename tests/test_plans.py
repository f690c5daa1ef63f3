"""Physical plan shape: pruning, pushdown, top-k, no Python, skew splitting."""

import contextlib
import io
import re

import pandas as pd
from pyspark.sql import functions as F

from callstats.operators import zscore_outliers
from callstats.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_top_spend_is_topk_over_two_columns(spark):
    plan = plan_text(QUERIES["top_spend"](spark, SF))
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    assert "partial_sum" in plan


def test_heatmap_and_revenue_one_scan_partial_agg(spark):
    for name in ("usage_heatmap", "revenue_total", "parsed_heatmap"):
        plan = plan_text(QUERIES[name](spark, SF))
        assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1, name
        assert "partial_" in plan, name


def test_outliers_native_and_pruned(spark):
    for name in ("outlier_events", "outlier_events_split", "outlier_events_shuffle", "stats_lookup"):
        plan = plan_text(QUERIES[name](spark, SF))
        assert not any(p in plan for p in PYTHON_NODES), name
        assert "props" not in plan and "event_type" not in plan, name


def test_outliers_broadcast_when_small_sortmerge_when_not(spark):
    assert "BroadcastHashJoin" in plan_text(QUERIES["outlier_events"](spark, SF))
    shuffled = plan_text(QUERIES["outlier_events_shuffle"](spark, SF))
    # The keys' statistics are shuffled; only the bounds of the hash cells, a table
    # of fixed size, are joined in place.
    assert "SortMergeJoin" in shuffled
    assert re.findall(r"BroadcastHashJoin\s+Left keys \[1\]: \[(\w+)#", shuffled) == ["_cell"]


def test_hot_key_is_split_by_aqe_and_result_is_exact(spark, monkeypatch):
    """One key holds half the rows; stats are too big to broadcast by rule.
    AQE must split the hot key's join partition, and the rows must equal a
    brute-force computation."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 200_000
        base = spark.range(n, numPartitions=8)
        df = base.select(
            F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
            F.col("id").alias("t"),
            F.when(F.col("id") % 40_009 == 0, F.lit(10_000.0))
            .otherwise((F.col("id") * 7919 % 101).cast("double"))
            .alias("v"),
        )
        # A key of small values keeps the bounds on the scan loose.
        calm = spark.range(100).select(
            F.lit(5_000).alias("k"), (F.col("id") + n).alias("t"), F.when(F.col("id") == 0, 1.0).otherwise(0.001 * (F.col("id") % 2)).alias("v")
        )
        df = df.unionByName(calm)
        # And one cell for all keys keeps the bounds before the join loose.
        monkeypatch.setattr("callstats.operators.outliers.MAX_CELLS", 1)
        out = zscore_outliers(df, "k", "v", keep=["t"], max_broadcast_rows=0)
        got = sorted((r["k"], r["t"]) for r in out.collect())
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final
        assert "skew=true" in final

        pdf = df.toPandas()
        g = pdf.groupby("k")["v"]
        pdf["m"], pdf["s"] = g.transform("mean"), g.transform("std")
        hit = pdf[(pdf["s"] > 0) & ((pdf["v"] - pdf["m"]).abs() > 3 * pdf["s"])]
        want = sorted(zip(hit["k"].tolist(), hit["t"].tolist()))
        assert got == want
        assert any(k == 0 for k, _ in got)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_split_keeps_hot_rows_in_place(spark):
    df = spark.range(50_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 5_000 == 0, 900.0).otherwise((F.col("id") % 17).cast("double")).alias("v"),
    )
    # The statistics fit a broadcast: one join, one scan, no shuffle of rows.
    plan = plan_text(zscore_outliers(df, "k", "v", keep=["t"], strategy="split", heavy_threshold=5_000))
    assert plan.count("Range (") <= 2 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # They do not: the hot key is judged by broadcast, the others sort-merge, still one scan.
    out = zscore_outliers(df, "k", "v", keep=["t"], strategy="split", heavy_threshold=5_000, max_broadcast_rows=0)
    plan = plan_text(out)
    assert plan.count("Range (") <= 2 and "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    ref = zscore_outliers(df, "k", "v", keep=["t"], max_broadcast_rows=0)
    assert ref.count() == 10
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ref.collect()))


def test_brute_force_matches_on_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = sorted((r["user_id"], r["event_id"]) for r in zscore_outliers(ev, "user_id", "value", keep=["event_id"]).collect())
    pdf = pd.read_parquet(f"{SF}/events.parquet")
    g = pdf.groupby("user_id")["value"]
    pdf["m"], pdf["s"] = g.transform("mean"), g.transform("std")
    hit = pdf[(pdf["s"] > 0) & ((pdf["value"] - pdf["m"]).abs() > 3 * pdf["s"])]
    assert got == sorted(zip(hit["user_id"].tolist(), hit["event_id"].tolist()))
    assert len(got) == 171


def test_counted_jobs_observe_in_the_final_stage(spark):
    """With ``input_rows`` the heatmap and revenue still scan once, and the
    metric node sits above the last exchange (the result stage)."""
    from pyspark.sql import Observation

    from callstats.plans.jobs import revenue_recon, tower_heatmap
    from callstats.plans.queries import EVENT_ROLES, ORDER_ROLES

    ev = spark.read.parquet(f"{SF}/events.parquet")
    od = spark.read.parquet(f"{SF}/orders.parquet")
    for df in (
        tower_heatmap(ev, EVENT_ROLES, input_rows=Observation("h")),
        revenue_recon(od, ORDER_ROLES, input_rows=Observation("r")),
    ):
        plan = plan_text(df, "simple")
        assert len(re.findall(r"FileScan parquet", plan)) == 1
        lines = plan.splitlines()
        metrics = next(i for i, line in enumerate(lines) if "CollectMetrics" in line)
        first_exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
        assert metrics < first_exchange or "Coalesce 1" in lines[metrics + 1]


def test_top_callers_counts_its_input_from_one_reused_shuffle(spark, tmp_path):
    """Top-k and input count read the same shuffled sums of a CSV: one scan, one
    exchange by key, no checkpoint in between."""
    from pyspark.sql import Observation

    from callstats.plans.jobs import top_callers
    from callstats.sources.cdr import read_cdr
    from tests.test_jobs import write_csv

    lines = [f"U{i % 13},U1,60,T1,2023-10-01T10:00:00,VOICE,{i}.25" for i in range(300)] + ["U1,U1,60,T1,x,VOICE,none"]
    src = read_cdr(spark, write_csv(str(tmp_path / "cdr.csv"), lines))
    seen = Observation("t")
    top = top_callers(src, n=5, input_rows=seen)
    assert len(top.collect()) == 5
    assert (seen.get["rows"], seen.get["rejected"]) == (301, 1)
    plan = top._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0] + plan.split("Subquery")[1].split("Initial Plan")[0]
    assert "ReusedExchange" in final and "Scan ExistingRDD" not in plan
    metrics = seen.get
    assert metrics["rows_of_top"] < metrics["rows"]
    empty = Observation("e")
    assert top_callers(src.limit(0), input_rows=empty).collect() == []


def test_cell_bounds_keep_rows_out_of_the_sort_merge_join(spark):
    """A narrow key with an outlier spoils the bound over all keys; the bounds of
    the keys' cells still drop nearly every row before the shuffle."""
    from callstats.operators import outliers

    wide = spark.range(200_000).select(
        (F.col("id") % 500).alias("k"), F.when(F.col("id") < 500, 90_000.0).otherwise(1000.0 + F.col("id") % 997).alias("v")
    )
    narrow = spark.range(400).select(F.lit(-1).cast("long").alias("k"), F.when(F.col("id") == 7, 1.5).otherwise(1.0).alias("v"))
    rows = wide.unionByName(narrow)
    stats = outliers._stats(rows, "k", "v").where(outliers._candidates(3.0))
    loosest = stats.agg(*outliers._loosest(3.0)).first()
    before = rows.where((F.col("v") < loosest["low"]) | (F.col("v") > loosest["high"])).count()
    after = outliers.beyond_bounds(rows, stats, "k", "v", 3.0, stats.count()).count()
    hits = zscore_outliers(rows, "k", "v", max_broadcast_rows=0).count()
    assert before > 199_000 and hits <= after < 2_000
    assert hits == zscore_outliers(rows, "k", "v").count() == 501
    # Few cells, many keys in each: looser, never wrong.
    few = outliers.bounds_by_cell(stats, "k", 3.0, 4)
    assert few.count() == 4 and few.where("low is null or high is null").count() == 0


def test_sketched_heavy_keys_shuffle_no_light_ones(spark):
    from callstats.operators.aggregates import heavy_hitters
    from callstats.operators.heavy import candidate_rows, heavy_hitters_sketched

    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 300 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k")
    )
    want = {(r["k"], r["n"]) for r in heavy_hitters(df, "k", 200).collect()}
    assert {(r["k"], r["n"]) for r in heavy_hitters_sketched(df, "k", 200).collect()} == want == {("hot", 30_000), (None, 300)}
    assert 30_300 <= candidate_rows(df, "k", 200).count() < 30_400  # a light key or two in a heavy cell
    # Cells shared with many light keys, and a lookup too large to broadcast.
    for cells, broadcast in ((64, 500_000), (1 << 20, 0)):
        found = heavy_hitters_sketched(df, "k", 200, cells=cells, max_broadcast_rows=broadcast)
        assert {(r["k"], r["n"]) for r in found.collect()} == want
    assert heavy_hitters_sketched(df.limit(0), "k", 0).count() == 0


def test_spread_placement_splits_large_keys_only(spark):
    from callstats.operators.partitioning import heavy_layout, key_bucket, spread_by_key

    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k")
    )
    layout, total = heavy_layout(df, "k", 1000)
    got = {r["k"]: (r["_first"], r["_parts"]) for r in layout.collect()}
    assert got == {None: (20, 4), "hot": (24, 20)} and total == 44
    placed = key_bucket(spread_by_key(df, "k", 1000), "k").withColumn("p", F.spark_partition_id())
    sizes = {r["p"]: r["count"] for r in placed.groupBy("p").count().collect()}
    assert sum(sizes.values()) == 40_000 and max(sizes.values()) < 2_000
    light = placed.where("k is not null and k <> 'hot'")
    assert light.count() == 16_000 and light.where("p <> bucket").count() == 0
    assert placed.where("k = 'hot' and (p < 24 or p >= 44)").count() == 0
    assert placed.columns == ["k", "bucket", "p"]
    assert spread_by_key(df.limit(0), "k", 10).count() == 0


def test_exact_input_count_takes_no_extra_pass(spark, tmp_path):
    """The default input count comes from the job's own pass: ``count()`` is
    never called on the source, and the count equals the table's rows."""
    from callstats.plans.jobs import JOBS, run_job
    from callstats.plans.queries import EVENT_ROLES

    events = spark.read.parquet(f"{SF}/events.parquet")
    rows = events.count()
    for name in JOBS:
        source = spark.read.parquet(f"{SF}/events.parquet")

        def no_count():
            raise AssertionError("extra pass over the input")

        source.count = no_count
        m = run_job(spark, name, source, str(tmp_path), "p", roles=EVENT_ROLES)
        assert m["input_record_count"] == rows, name


def test_csv_job_paths_compile_to_whole_stage_code(spark, tmp_path):
    """The heatmap's parse-and-count and the anomaly job's scan-join-round
    run as generated code: the scan, the parse, the join and the rounding
    sit inside WholeStageCodegen subtrees, with no Python node."""
    from callstats.plans.jobs import anomalous_calls, tower_heatmap
    from callstats.sources.cdr import read_cdr
    from tests.test_jobs import write_csv

    lines = [f"U{i % 13},U1,{9000 if i == 0 else 60 + i % 7},T{i % 3},2023-10-01T{i % 24:02d}:00:00,VOICE,1.25" for i in range(300)]
    src = read_cdr(spark, write_csv(str(tmp_path / "cdr.csv"), lines))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the codegen stages before execution
    try:
        for df, inside in (
            (tower_heatmap(src), ("RLIKE", "partial_count")),
            (anomalous_calls(src), ("BroadcastHashJoin", "format_number")),
        ):
            text = plan_text(df, "codegen")
            n = int(re.search(r"Found (\d+) WholeStageCodegen subtrees", text).group(1))
            assert n >= 2
            assert all(token in text for token in inside)
            assert not any(p in text for p in PYTHON_NODES)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_candidate_bounds_reach_the_scan(spark):
    """The sort-merge branch reads the rows with a pushed bound on the value."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = zscore_outliers(ev, "user_id", "value", keep=["event_id"], max_broadcast_rows=0)
    pushed = re.findall(r"PushedFilters: (.*)", plan_text(out))
    assert any("LessThan(value" in p and "GreaterThan(value" in p for p in pushed)
    assert out.count() == 171
