"""Every registered query against its DuckDB oracle, exact values."""

import pytest

import __spark_entry__ as entry
from tests.oracle import duck, rows_of_duck, rows_of_spark

SFS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module", params=SFS, ids=["sf0.001", "sf0.01"])
def sf(request):
    return request.param, duck(request.param)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, name):
    sf_dir, con = sf
    got_cols, got = rows_of_spark(entry.queries()[name](spark, sf_dir))
    want_cols, want = rows_of_duck(con, entry.oracle_sql()[name])
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_oracle():
    # The operators that SQL cannot express are held against brute force in tests/llm.
    others = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}
    assert set(entry.queries()) - others == set(entry.oracle_sql()) - others
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["caller_id", "call_timestamp", "duration_sec", "user_mean_duration", "user_stddev"]
    assert df.count() == 15
