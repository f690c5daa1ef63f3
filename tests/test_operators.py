"""Operator edge cases on hand-made rows."""

import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.functions import exact_sum, parse_timestamp
from callstats.operators import (
    can_exceed,
    group_stats,
    heavy_group_stats,
    heavy_hitters,
    key_bucket,
    repartition_by_key,
    stats_lookup,
    top_by_sum,
    total,
    zscore_outliers,
)

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("v", T.DoubleType()),
        T.StructField("t", T.StringType()),
    ]
)


def frame(spark, groups):
    """groups: {key: [values]} -> rows (key, value, t) with t = key:index."""
    rows = [(k, v, f"{k}:{i}") for k, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, SCHEMA)


def outlier_set(df, **kw):
    out = zscore_outliers(df, "k", "v", keep=["t"], **kw)
    return sorted((r["k"], r["t"]) for r in out.collect())


@pytest.mark.parametrize("strategy", ["auto", "split"])
def test_small_and_flat_groups(spark, strategy):
    df = frame(
        spark,
        {
            "zero_spread": [5.0] * 12,
            "single": [7.0],
            "ten": [1.0] * 9 + [1000.0],
            "eleven": [1.0] * 10 + [1000.0],
        },
    )
    assert outlier_set(df, strategy=strategy, heavy_threshold=5) == [("eleven", "eleven:10")]


def test_can_exceed_bound_is_exact_for_k3(spark):
    df = spark.range(1, 40).select(F.col("id").alias("n"))
    kept = [r["n"] for r in df.where(can_exceed(F.col("n"), 3.0)).collect()]
    assert min(kept) == 11 and len(kept) == 29


def test_null_key_and_null_value(spark):
    df = frame(spark, {"a": [1.0] * 10 + [1000.0, None], None: [1.0] * 10 + [1000.0]})
    got = outlier_set(df)
    assert got == [("a", "a:10")]


@pytest.mark.parametrize("strategy", ["auto", "split"])
def test_strategies_equal_with_heavy_key(spark, strategy):
    groups = {"whale": [float(i % 50) for i in range(3000)] + [5000.0]}
    for u in range(30):
        groups[f"u{u}"] = [float((u * 7 + i) % 13) for i in range(40)] + ([400.0] if u % 3 == 0 else [])
    df = frame(spark, groups)
    want = outlier_set(df, strategy="auto", max_broadcast_rows=0)
    got = outlier_set(df, strategy=strategy, heavy_threshold=1000)
    assert got == want
    assert ("whale", "whale:3000") in got
    assert len(got) == 11


def test_split_bound_on_heavy_keys(spark):
    # 40 keys of 100 rows each, threshold 10: with max_heavy_keys=8 the cut
    # rises to 4000 // 8 = 500 rows, so no key is broadcast as heavy, and the
    # result is still complete.
    groups = {f"k{i}": [float(j % 9) for j in range(99)] + [100.0] for i in range(40)}
    df = frame(spark, groups)
    got = outlier_set(df, strategy="split", heavy_threshold=10, max_heavy_keys=8)
    assert len(got) == 40


def test_group_stats_and_heavy(spark):
    df = frame(spark, {"a": [1.0, 2.0, 3.0], "b": [4.0], "c": [1.0] * 4})
    stats = {r["k"]: r for r in group_stats(df, "k", "v").collect()}
    assert stats["a"]["n"] == 3 and stats["a"]["mean"] == 2.0 and stats["a"]["stddev"] == 1.0
    assert stats["b"]["stddev"] is None
    assert stats["c"]["stddev"] == 0.0
    # strict '>': a key with exactly the threshold count is not heavy
    assert sorted(r["k"] for r in heavy_hitters(df, "k", 3).collect()) == ["c"]
    heavy = {r["k"]: r for r in heavy_group_stats(df, "k", "v", 0).collect()}
    assert heavy["b"]["stddev"] == 0.0


def test_stats_lookup_defaults(spark):
    df = frame(spark, {"a": [1.0, 3.0, 5.0], "b": [4.0]})
    got = {r["t"]: (r["is_heavy"], r["mean"], r["stddev"]) for r in stats_lookup(df, "k", "v", 2).collect()}
    assert got["a:0"] == (True, 3.0, 2.0)
    assert got["b:0"] == (False, 0.0, 0.0)


def test_top_by_sum_ties_and_cents(spark):
    rows = [("b", 0.10), ("b", 0.20), ("a", 0.30), ("c", 510000.00), ("c", 123.45), ("d", 0.05)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = [(r["k"], r["total"]) for r in top_by_sum(df, "k", "v", n=3).collect()]
    # 0.1 + 0.2 is 0.30000000000000004 in doubles; exact sums tie and the key decides.
    assert got == [("c", 510123.45), ("a", 0.30), ("b", 0.30)]


def test_top_by_sum_keeps_null_key(spark):
    df = spark.createDataFrame([(None, 5.0), ("a", 1.0)], "k string, v double")
    got = [(r["k"], r["total"]) for r in top_by_sum(df, "k", "v").collect()]
    assert got == [(None, 5.0), ("a", 1.0)]


def test_total_empty_is_one_null_row(spark):
    df = spark.createDataFrame([], "v double")
    assert [tuple(r) for r in total(df, "v").collect()] == [(None,)]


def test_parse_timestamp_formats(spark):
    texts = ["2023-10-01T12:34:56", "2023-10-01T12:34:56.123456", "garbage", "", None, "2023-10-01 12:34:56"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["h"] for r in df.select(F.hour(parse_timestamp("t")).alias("h")).collect()]
    assert got == [12, 12, None, None, None, 12]


def test_length_guard_never_changes_a_parse(spark):
    from callstats.functions.time import CDR_TIME_FORMATS

    texts = [
        "2023-10-01T12:34:56.25",
        "2023-10-01T12:34:56.1",
        "2023-10-01T12:34:56.1234567",
        "2023-10-01T12:34:56.",
        "999-10-01T12:34:56",
        "2023-1-01T12:34:56",
        "12023-10-01T12:34:56",
        "2023-10-01T12:34:56",
        "2023-10-01T12:34:56.123456",
        " 2023-10-01T12:34:56",
        "2023-10-01T12:34:56Z",
        "2023-10-01T24:00:00",
        "2023-02-30T12:00:00",
        "",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)) for f in CDR_TIME_FORMATS])
    rows = df.select("t", plain.alias("a"), parse_timestamp("t").alias("b")).collect()
    # What a layout accepts is unchanged; other ISO text is read by the cast.
    assert all(r["a"] == r["b"] for r in rows if r["a"] is not None)
    more = {r["t"] for r in rows if r["a"] is None and r["b"] is not None}
    assert more == {
        "2023-10-01T12:34:56.1234567", "2023-10-01T12:34:56.", "2023-1-01T12:34:56", " 2023-10-01T12:34:56", "2023-10-01T12:34:56Z"
    }


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_of_odd_amounts(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [("eighths", 0.125)] * 1000 + [("tiny", 4e-10)] * 1000 + [("nan", 1.0), ("nan", float("nan"))]
        rows += [("huge", 9e16)] * 2 + [("inf", float("inf")), ("null", None), ("mixed", 0.1), ("mixed", 0.00000001)]
        df = spark.createDataFrame(rows, "k string, v double")
        got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert got["eighths"] == 125.0 and got["huge"] == 1.8e17 and got["inf"] == float("inf")
    assert got["nan"] != got["nan"] and got["null"] is None and got["mixed"] == 0.10000001
    assert abs(got["tiny"] - 4e-7) < 1e-15


def test_outliers_of_columns_named_like_statistics(spark):
    rows = [(1, float(i % 3), i) for i in range(50)] + [(1, 900.0, 99)]
    df = spark.createDataFrame(rows, "stddev int, mean double, n int")
    out = zscore_outliers(df, "stddev", "mean", keep=["n"], out_mean="m", out_stddev="s")
    assert [(r["stddev"], r["mean"], r["n"]) for r in out.collect()] == [(1, 900.0, 99)]


def test_key_bucket_matches_zlib(spark):
    keys = ["WHALE_CALLER_999", "USER_1", "USER_50000", "", "é"] + [f"USER_{i}" for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string")
    got = {r["k"]: r["bucket"] for r in key_bucket(df, "k").collect()}
    for k in keys:
        assert got[k] == zlib.crc32(k.encode("utf-8")) % 20
    assert got[None] == 0
    assert got["WHALE_CALLER_999"] == 18


def test_repartition_by_key_places_every_row(spark):
    df = spark.createDataFrame([(f"USER_{i}",) for i in range(500)], "k string")
    placed = key_bucket(repartition_by_key(df, "k"), "k").withColumn("pid", F.spark_partition_id())
    assert placed.rdd.getNumPartitions() == 20
    assert placed.where(F.col("pid") != F.col("bucket")).count() == 0


@pytest.mark.parametrize("strategy", ["auto", "split"])
def test_outliers_on_empty_and_candidate_free_input(spark, strategy):
    empty = spark.createDataFrame([], SCHEMA)
    assert outlier_set(empty, strategy=strategy) == []
    small = frame(spark, {"a": [1.0, 2.0, 900.0], "b": [3.0] * 5})
    assert outlier_set(small, strategy=strategy) == []


def test_lookup_side_holds_only_keys_with_an_outlier(spark):
    """40 keys qualify by size and spread, 3 of them hold an outlier. With a
    broadcast bound of 5 rows the stats still broadcast, because only keys
    whose minimum or maximum passes the test are kept; the rows equal a
    brute-force pass."""
    import contextlib
    import io

    groups = {f"k{i:02d}": [10.0 + (j % 5) for j in range(20)] for i in range(40)}
    for i in (3, 17, 31):
        groups[f"k{i:02d}"][7] = 500.0
    df = frame(spark, groups)
    out = zscore_outliers(df, "k", "v", keep=["t"], max_broadcast_rows=5)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "BroadcastHashJoin" in buf.getvalue() and "SortMergeJoin" not in buf.getvalue()
    assert sorted((r["k"], r["t"]) for r in out.collect()) == [("k03", "k03:7"), ("k17", "k17:7"), ("k31", "k31:7")]


def test_extreme_value_test_is_exact_at_the_boundary(spark):
    """A value exactly k sigma away is not an outlier (strict >), and the
    key-level pruning must not keep or drop anything the row test would not."""
    import statistics

    base = [0.0] * 10 + [1.0]
    m, s = statistics.mean(base), statistics.stdev(base)
    df = frame(spark, {"a": base, "b": base + [m + 3 * s]})
    want = []
    for key, vs in (("a", base), ("b", base + [m + 3 * s])):
        mm, ss = statistics.mean(vs), statistics.stdev(vs)
        want += [(key, f"{key}:{i}") for i, v in enumerate(vs) if abs(v - mm) > 3 * ss]
    assert outlier_set(df) == sorted(want)


def test_round_exact_matches_python_round(spark):
    """Ties in the shortest decimal text (2271.075 is 2271.07499...) and exact
    binary ties (123.125) round as Python's round does; F.round differs."""
    import math
    import random

    from callstats.functions import round_exact

    rng = random.Random(3)
    vals = [2271.075, 2.675, 1.005, 123.125, 0.125, -2.675, -0.125, 0.0, 1e-9, 5e15 + 0.5, 3302.685]
    vals += [rng.randint(0, 10**6) / 1000 for _ in range(500)] + [rng.randint(1, 10**5) / 40 for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)] + [(-1, float("nan")), (-2, None)], "i long, v double")
    got = {r["i"]: r["r"] for r in df.select("i", round_exact("v", 2).alias("r")).collect()}
    assert all(got[i] == round(v, 2) for i, v in enumerate(vals))
    assert math.isnan(got[-1]) and got[-2] is None
    assert round(2271.075, 2) == 2271.07 and df.where("i = 0").select(F.round("v", 2)).first()[0] == 2271.08
