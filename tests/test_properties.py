"""Property test: k-sigma outliers equal a brute-force pandas computation."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from callstats.operators import zscore_outliers

groups = st.dictionaries(
    keys=st.sampled_from(["a", "b", "c", "d", "e"]),
    values=st.lists(
        st.one_of(st.integers(-50, 50).map(float), st.sampled_from([500.0, -900.0, 10_000.0])),
        min_size=1,
        max_size=40,
    ),
    min_size=1,
    max_size=5,
)


def brute_force(rows, k):
    pdf = pd.DataFrame(rows, columns=["k", "v", "t"])
    g = pdf.groupby("k")["v"]
    pdf["m"], pdf["s"] = g.transform("mean"), g.transform("std")
    hit = pdf[(pdf["s"] > 0) & ((pdf["v"] - pdf["m"]).abs() > k * pdf["s"])]
    return sorted(hit["t"].tolist())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=groups, k=st.sampled_from([2.0, 3.0]), strategy=st.sampled_from(["auto", "split"]))
def test_outliers_equal_brute_force(spark, data, k, strategy):
    rows = [(key, v, i) for key, vs in sorted(data.items()) for i, v in enumerate(vs, start=1000 * ord(key))]
    df = spark.createDataFrame(rows, "k string, v double, t long")
    out = zscore_outliers(df, "k", "v", keep=["t"], k=k, strategy=strategy, heavy_threshold=10, max_broadcast_rows=2)
    assert sorted(r["t"] for r in out.collect()) == brute_force(rows, k)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.one_of(st.none(), st.integers(0, 500).map(lambda c: c / 100))),
        min_size=1,
        max_size=60,
    ),
    n=st.integers(1, 4),
)
def test_counted_top_by_sum_equals_brute_force(spark, rows, n):
    """With ``input_rows`` the count is every input row and the top ``n``
    (exact cents, ties by key, NULL key last) equals a brute-force ranking."""
    from pyspark.sql import Observation

    from callstats.operators import top_by_sum

    df = spark.createDataFrame(rows, "k string, v double")
    obs = Observation("p")
    got = [(r["k"], r["total"]) for r in top_by_sum(df, "k", "v", n=n, input_rows=obs).collect()]
    assert obs.get["rows"] == len(rows)
    sums = {}
    for k, v in rows:
        cents = sums.get(k)
        if v is not None:
            cents = (cents or 0) + round(v * 100)
        sums[k] = cents
    ranked = sorted(sums.items(), key=lambda kv: (kv[1] is None, -(kv[1] or 0), kv[0] is None, kv[0] or ""))
    assert got == [(k, None if c is None else c / 100) for k, c in ranked[:n]]
