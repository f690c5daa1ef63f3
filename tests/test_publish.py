"""Publication by pointer, attempts' records and the check by part statistics."""

import glob
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from callstats.plans.jobs import JOBS, run_job
from callstats.schema import REVENUE_SCHEMA, Roles
from callstats.sinks import manifest, publish, results
from callstats.sinks.manifest import check_manifests, check_parts, leftovers, read_manifests
from callstats.sources.cdr import read_result

ROLES = Roles(caller="k", charge="v", duration="v", tower="k", timestamp="t")
JOB = JOBS["revenue_recon"].job_name


class Killed(BaseException):
    """Not an Exception: like a killed driver, nothing is cleaned up after it."""


def rows(spark, values):
    return spark.createDataFrame([("a", float(v), "2024-01-01T00:00:00") for v in values], "k string, v double, t string")


def revenue(spark, base, run_id="r"):
    (row,) = read_result(spark, f"{base}/{JOB}/{run_id}", REVENUE_SCHEMA).collect()
    return row[0]


STEPS = ["write_parts", "write_part_statistics", "write_manifest", "publish"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_kill_at_any_step_leaves_a_whole_result(spark, tmp_out, monkeypatch, step, after):
    from callstats.plans import jobs

    run_job(spark, "revenue_recon", rows(spark, [1, 2]), tmp_out, "r", roles=ROLES)
    real = getattr(jobs, step)

    def dying(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Killed

    monkeypatch.setattr(jobs, step, dying)
    with pytest.raises(Killed):
        run_job(spark, "revenue_recon", rows(spark, [5, 6]), tmp_out, "r", roles=ROLES)
    monkeypatch.undo()
    done = step == "publish" and after
    assert revenue(spark, tmp_out) == (11.0 if done else 3.0)
    (m,) = read_manifests(spark, tmp_out).collect()
    assert (m["status"], m["input_record_count"]) == ("SUCCESS", 2)
    (c,) = check_manifests(spark, tmp_out).collect()
    assert c["ok"] and c["actual_rows"] == 1
    begun = done or (step == "write_parts" and not after)  # published, or nothing written yet
    assert leftovers(spark, tmp_out).count() == (0 if begun else 1)
    # The killed attempt is no obstacle, and can be swept away later.
    run_job(spark, "revenue_recon", rows(spark, [7]), tmp_out, "r", roles=ROLES)
    assert revenue(spark, tmp_out) == 7.0
    assert publish.sweep(spark, f"{tmp_out}/{JOB}/r", timedelta(hours=1)) == []
    publish.sweep(spark, f"{tmp_out}/{JOB}/r", timedelta(0))
    assert leftovers(spark, tmp_out).count() == 0 and revenue(spark, tmp_out) == 7.0


def test_publication_renames_nothing_and_overwrites_nothing(spark, tmp_out):
    seen = {}
    for n in range(4):
        run_job(spark, "revenue_recon", rows(spark, [n]), tmp_out, "r", roles=ROLES)
        now = {}
        for path in glob.glob(f"{tmp_out}/{JOB}/r/**", recursive=True):
            if os.path.isfile(path):
                with open(path, "rb") as f:
                    now[path] = f.read()
        assert all(now[p] == body for p, body in seen.items() if p in now)
        seen = now
    # The last versions stay, for readers of the former one.
    assert [v for v, _ in publish.versions(spark, f"{tmp_out}/{JOB}/r")] == [3, 4]
    assert len(glob.glob(f"{tmp_out}/{JOB}/r/attempt-*")) == publish.KEPT_VERSIONS
    assert revenue(spark, tmp_out) == 3.0


def test_two_pointers_of_one_version_have_one_winner(spark, tmp_out):
    folder = f"{tmp_out}/j/r"
    first, second = publish.attempt_of(folder), publish.attempt_of(folder)
    for attempt in (second, first):
        os.makedirs(attempt)
    publish.publish(spark, second)
    os.makedirs(f"{folder}/_CURRENT", exist_ok=True)
    open(f"{folder}/_CURRENT/000000001~{os.path.basename(first)}", "w").close()
    assert publish.current(spark, folder) == second
    assert publish.current(spark, f"{tmp_out}/none") is None


@pytest.mark.parametrize("name", list(JOBS))
def test_a_failure_has_the_input_count_and_stands_beside_the_result(spark, tmp_out, name):
    good = rows(spark, [10.0] * 30 + [900.0])
    run_job(spark, name, good, tmp_out, "r", roles=ROLES)
    bad = good.withColumn("v", F.when(F.col("v") > 100, F.raise_error(F.lit("bad"))).otherwise(F.col("v")).cast("double"))
    bad = bad.withColumn("t", F.when(F.col("v") > 100, F.raise_error(F.lit("bad"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="bad"):
        run_job(spark, name, bad, tmp_out, "r", roles=ROLES, input_count="exact")
    found = {m["status"]: m for m in read_manifests(spark, tmp_out).collect()}
    assert sorted(found) == ["FAILURE", "SUCCESS"]
    assert all(m["input_record_count"] == 31 for m in found.values())
    assert found["FAILURE"]["output_record_count"] == 0
    (c,) = check_manifests(spark, tmp_out).collect()
    assert not c["ok"] and c["actual_rows"] == c["expected_rows"] == found["SUCCESS"]["output_record_count"]
    # A later success ends it; the record stays in the history.
    run_job(spark, name, good, tmp_out, "r", roles=ROLES)
    assert [m["status"] for m in read_manifests(spark, tmp_out).collect()] == ["SUCCESS"]
    assert [c["ok"] for c in check_manifests(spark, tmp_out).collect()] == [True]
    assert read_manifests(spark, tmp_out, history=True).where("status = 'FAILURE'").count() == 1


def test_a_failure_while_publishing_keeps_the_observed_count(spark, tmp_out, monkeypatch):
    """The pass over the input was done: its count is used, not a second pass."""
    from callstats.plans import jobs

    def fail(*_):
        raise OSError("no space")

    monkeypatch.setattr(jobs, "write_part_statistics", fail)
    monkeypatch.setattr(jobs, "counted_after_failure", lambda _: pytest.fail("counted again"))
    for name in JOBS:
        with pytest.raises(OSError):
            run_job(spark, name, rows(spark, [1, 2, 3]), tmp_out, "r", roles=ROLES)
    assert [m["input_record_count"] for m in read_manifests(spark, tmp_out).collect()] == [3] * len(JOBS)


def odd_lines(n):
    rng = random.Random(n)
    letters = ["a", '"', "\\", "\n", "\r", ",", " ", "é", "'"]

    def text(most):
        return "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))

    return [(rng.choice([None, text(8)]), text(5), k) for k in range(n)]


@pytest.mark.parametrize("split", ["128m", "3k", "300b"])
def test_records_are_counted_by_lines_at_any_split(spark, tmp_out, split):
    df = spark.createDataFrame(odd_lines(1500), "a string, b string, c long").repartition(3)
    parts = results.write_parts(df, f"{tmp_out}/x")
    assert sum(p["rows"] for p in parts) == 1500 and len(parts) == 3
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = {os.path.basename(r["file"]): r["records"] for r in results.count_records(spark, f"{tmp_out}/x").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found == {p["part"]: p["rows"] for p in parts}
    assert all(os.path.getsize(f"{tmp_out}/x/{p['part']}") == p["bytes"] for p in parts)


def published(spark, base, df):
    attempt = publish.attempt_of(f"{base}/lines/r")
    parts = results.write_parts(df, attempt)
    manifest.write_part_statistics(spark, parts, attempt)
    record = manifest.manifest_record("lines", "r", "in", attempt, 1, sum(p["rows"] for p in parts), "SUCCESS")
    manifest.write_manifest(spark, record, attempt)
    publish.publish(spark, attempt)
    return attempt, [p["part"] for p in parts]


@pytest.mark.parametrize("damage", ["none", "cut", "lost", "added", "same size"])
def test_parts_that_changed_are_named(spark, tmp_out, damage):
    df = spark.createDataFrame(odd_lines(300), "a string, b string, c long").repartition(3)
    attempt, parts = published(spark, tmp_out, df)
    path = f"{attempt}/{parts[1]}"
    os.remove(f"{attempt}/.{parts[1]}.crc")  # the local file system's own check
    if damage == "cut":
        with open(path, "r+b") as f:
            f.truncate(os.path.getsize(path) // 2)
    elif damage == "lost":
        os.remove(path)
    elif damage == "added":
        path = f"{attempt}/part-00009-extra.csv"
        with open(path, "w", encoding="utf-8") as f:
            f.write("x,y,1\n")
    elif damage == "same size":  # a break within the text more, a record more
        with open(path, "r+b") as f:
            f.seek(os.path.getsize(path) - 2)
            f.write(b"\n")
    bad = [os.path.basename(path)] if damage != "none" else []
    assert [r["part"] for r in check_parts(spark, tmp_out).where("not ok").collect()] == bad
    (c,) = check_manifests(spark, tmp_out).collect()
    assert c["ok"] == (damage == "none")


def test_check_plans_no_multiline_read_and_splits_files(spark, tmp_out):
    published(spark, tmp_out, spark.range(5).withColumn("a", F.lit("x")))
    plan = check_parts(spark, tmp_out)._jdf.queryExecution().toString()
    assert "multiLine" not in plan and "FileScan text" in plan and "FileScan csv" not in plan


def test_a_run_whose_attempts_all_failed(spark, tmp_out):
    for _ in range(2):
        with pytest.raises(Exception):
            run_job(spark, "revenue_recon", lambda: spark.read.parquet("/nonexistent"), tmp_out, "r")
    assert [m["input_record_count"] for m in read_manifests(spark, tmp_out).collect()] == [0, 0]
    (c,) = check_manifests(spark, tmp_out).collect()
    assert (c["expected_rows"], c["actual_rows"], c["ok"]) == (0, 0, False)
    assert leftovers(spark, tmp_out).count() == 0


def test_rejects_are_kept_whole_with_their_raw_line(spark, tmp_path, tmp_out):
    """As many as the record counts, for every job, from CSV and from Parquet."""
    from callstats.plans.jobs import run
    from callstats.schema import CDR_SCHEMA
    from callstats.sinks.rejects import RAW_LINE, read_rejects
    from tests.test_jobs import write_csv

    lines = ["U1,U2,60,T1,2023-10-01T01:00:00,VOICE,1.5", "U2,U2,60,T1,2023-10-01T01:00:00,VOICE,1 EUR",
             ",U2,60,T1,2023-10-01T01:00:00,VOICE,2.5", "U3,U2,xx,T1,garbage,VOICE,"]
    csv = write_csv(str(tmp_path / "cdr.csv"), lines)
    parquet = str(tmp_path / "cdr.parquet")
    from callstats.sources.cdr import read_cdr

    read_cdr(spark, csv).write.parquet(parquet)
    schema = type(CDR_SCHEMA)([*CDR_SCHEMA.fields]).add(RAW_LINE, "string")
    wanted = {"top_callers": {"U2", "U3"}, "tower_heatmap": {"U3"}, "anomalous_calls": {None, "U3"}, "revenue_recon": {"U2", "U3"}}
    for path in (csv, parquet):
        for name, callers in wanted.items():
            m = run(spark, name, path, tmp_out, "r", keep_rejects=True)
            kept = read_rejects(spark, f"{tmp_out}/{m['job_name']}/r", schema).collect()
            assert {r["caller_id"] for r in kept} == callers and len(kept) == m["rejected_record_count"], (path, name)
            if path == csv:
                assert {r["caller_id"]: r[RAW_LINE] for r in kept}["U3"] == lines[3]
    # None rejected, or not asked for: nothing is kept, and the result is the same.
    good = write_csv(str(tmp_path / "good.csv"), lines[:1])
    m = run(spark, "revenue_recon", good, tmp_out, "g", keep_rejects=True)
    assert read_rejects(spark, f"{tmp_out}/{m['job_name']}/g", schema).count() == 0
    m = run(spark, "revenue_recon", csv, tmp_out, "n")
    assert read_rejects(spark, f"{tmp_out}/{m['job_name']}/n", schema).count() == 0
    assert all(r["ok"] for r in check_manifests(spark, tmp_out).collect())
