"""The four jobs on a skewed CDR CSV: one caller holds a third of all rows.

The CSV is made with ``spark.range`` (deterministic hashes), written once, and
read by the jobs through ``run`` and by DuckDB directly; results must be equal.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from callstats.plans.jobs import run
from callstats.schema import ANOMALY_SCHEMA, HEATMAP_SCHEMA, REVENUE_SCHEMA, TOP_CALLERS_SCHEMA
from callstats.sources.cdr import read_result

ROWS = 600_000


def h(salt):
    return F.xxhash64(F.col("id"), F.lit(salt))


@pytest.fixture(scope="module")
def skewed_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skewed") / "cdr")
    whale = F.pmod(F.col("id"), F.lit(3)) == 0
    df = spark.range(0, ROWS, numPartitions=8).select(
        F.when(whale, F.lit("WHALE_CALLER_999"))
        .otherwise(F.concat(F.lit("USER_"), F.pmod(h(1), F.lit(5000)).cast("string")))
        .alias("caller_id"),
        F.concat(F.lit("USER_"), F.pmod(h(2), F.lit(5000)).cast("string")).alias("receiver_id"),
        F.when(F.pmod(h(3), F.lit(1000)) == 0, F.lit(30000))
        .otherwise(F.pmod(h(4), F.lit(3591)) + 10)
        .cast("int")
        .alias("duration_sec"),
        F.concat(F.lit("TOWER_"), F.lpad((F.pmod(h(5), F.lit(100)) + 1).cast("string"), 3, "0")).alias("tower_id"),
        F.date_format(
            F.timestamp_seconds(F.lit(1696118400) + F.pmod(h(6), F.lit(2592000))), "yyyy-MM-dd'T'HH:mm:ss"
        ).alias("timestamp"),
        F.element_at(F.array(F.lit("VOICE"), F.lit("SMS"), F.lit("DATA")), (F.pmod(h(7), F.lit(3)) + 1).cast("int")).alias(
            "call_type"
        ),
        ((F.pmod(h(8), F.lit(491)) + 10) / F.lit(100.0)).alias("charge_amount"),
    )
    df.write.option("header", True).csv(path)
    return path


def duck_view(path):
    con = duckdb.connect()
    con.execute(
        f"""create view cdr as select * from read_csv('{path}/*.csv', header = true, columns = {{
        'caller_id': 'VARCHAR', 'receiver_id': 'VARCHAR', 'duration_sec': 'INTEGER', 'tower_id': 'VARCHAR',
        'timestamp': 'VARCHAR', 'call_type': 'VARCHAR', 'charge_amount': 'DOUBLE'}})"""
    )
    return con


ORACLE = {
    "top_callers": """
        select caller_id, cast(sum(cast(charge_amount as decimal(18,2))) as double) as total_spend
        from cdr group by caller_id order by total_spend desc, caller_id limit 100""",
    "tower_heatmap": """
        select tower_id, cast(hour(strptime(timestamp, '%Y-%m-%dT%H:%M:%S')) as int) as hour_of_day,
               count(*) as call_count
        from cdr group by 1, 2""",
    "anomalous_calls": """
        with st as (select caller_id as c, avg(duration_sec) as m, stddev_samp(duration_sec) as s
                    from cdr group by caller_id)
        select caller_id, timestamp as call_timestamp, duration_sec,
               cast(printf('%.2f', m) as double) as user_mean_duration,
               cast(printf('%.2f', s) as double) as user_stddev
        from cdr join st on caller_id = c where s > 0 and abs(duration_sec - m) > 3 * s""",
    "revenue_recon": "select cast(sum(cast(charge_amount as decimal(18,2))) as double) as total_revenue from cdr",
}

SCHEMAS = {
    "top_callers": TOP_CALLERS_SCHEMA,
    "tower_heatmap": HEATMAP_SCHEMA,
    "anomalous_calls": ANOMALY_SCHEMA,
    "revenue_recon": REVENUE_SCHEMA,
}

CASES = [
    ("top_callers", {}),
    ("tower_heatmap", {}),
    ("anomalous_calls", {"strategy": "auto"}),
    ("anomalous_calls", {"strategy": "split"}),
    ("revenue_recon", {}),
]


@pytest.mark.parametrize("name,params", CASES, ids=[f"{n}-{p.get('strategy', '')}" for n, p in CASES])
def test_job_on_skewed_csv_equals_duckdb(spark, skewed_csv, tmp_out, name, params):
    m = run(spark, name, skewed_csv, tmp_out, "skew", **params)
    assert m["status"] == "SUCCESS" and m["input_record_count"] == ROWS
    got = sorted(tuple(r) for r in read_result(spark, m["output_path"], SCHEMAS[name]).collect())
    want = sorted(duck_view(skewed_csv).sql(ORACLE[name]).fetchall())
    assert got == want
    assert m["output_record_count"] == len(want)
    if name == "anomalous_calls":
        assert any(r[0] == "WHALE_CALLER_999" for r in got)
