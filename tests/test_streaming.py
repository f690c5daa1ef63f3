"""Incremental runs give the same result as the batch job over the same files."""

import pytest

from callstats.plans.jobs import JOBS, run
from callstats.schema import HEATMAP_SCHEMA, REVENUE_SCHEMA, TOP_CALLERS_SCHEMA
from callstats.sinks.manifest import check_manifests
from callstats.sources.cdr import read_result
from callstats.streaming import read_cdr_stream, start_incremental
from tests.test_jobs import write_csv

SCHEMAS = {"tower_heatmap": HEATMAP_SCHEMA, "revenue_recon": REVENUE_SCHEMA, "top_callers": TOP_CALLERS_SCHEMA}


def cdr_lines(day, n):
    return [
        f"USER_{i % 7},USER_1,{60 + i},TOWER_00{i % 3},2023-10-0{day}T{i % 24:02d}:00:00,VOICE,{(i % 9) + 0.25:.2f}"
        for i in range(n)
    ]


@pytest.mark.parametrize("name", ["tower_heatmap", "revenue_recon", "top_callers"])
def test_incremental_equals_batch(spark, tmp_path, name):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out, ckpt, batch_out = str(tmp_path / "out"), str(tmp_path / "ckpt"), str(tmp_path / "batch")
    write_csv(str(inbox / "a.csv"), cdr_lines(1, 50))
    write_csv(str(inbox / "b.csv"), cdr_lines(2, 30))

    def snapshot():
        q = start_incremental(spark, name, read_cdr_stream(spark, str(inbox)), out, ckpt, run_id="s")
        q.awaitTermination(120)
        return q.lastProgress["batchId"]

    def rows(path):
        return sorted(map(tuple, read_result(spark, path, SCHEMAS[name]).collect()), key=repr)

    first = snapshot()
    write_csv(str(inbox / "c.csv"), cdr_lines(3, 40))
    last = snapshot()
    assert last > first

    m = run(spark, name, str(inbox), batch_out, "b")
    job = JOBS[name].job_name
    assert rows(f"{out}/{job}/s-b{last}") == rows(m["output_path"])
    assert all(r["ok"] for r in check_manifests(spark, out).collect())


def test_stream_reads_columns_by_header_name(spark, tmp_path):
    """Files in another column order stream into the right columns."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    order = ["charge_amount", "caller_id", "timestamp", "tower_id", "duration_sec", "call_type", "receiver_id"]
    lines = [l.split(",") for l in cdr_lines(1, 20)]
    names = "caller_id,receiver_id,duration_sec,tower_id,timestamp,call_type,charge_amount".split(",")
    with open(inbox / "a.csv", "w", encoding="utf-8") as f:
        f.write(",".join(order) + "\n")
        for cells in lines:
            row = dict(zip(names, cells))
            f.write(",".join(row[n] for n in order) + "\n")
    q = start_incremental(spark, "revenue_recon", read_cdr_stream(spark, str(inbox)), out, ckpt, run_id="h")
    q.awaitTermination(120)
    last = q.lastProgress["batchId"]
    (row,) = read_result(spark, f"{out}/{JOBS['revenue_recon'].job_name}/h-b{last}", REVENUE_SCHEMA).collect()
    assert row["total_revenue"] == pytest.approx(sum(float(c[-1]) for c in lines))
