"""Command line: ``spark-submit callstats/cli.py <job> <run_id> [<input_path>]``,
or ``... check [<output_base>]`` to check every run's manifest against its
stored rows (the reference's post-run check).

Also ``python -m callstats ...``. Prints the run manifest as JSON; exits
non-zero (after writing a FAILURE manifest) when the job fails.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from callstats.plans.jobs import INPUT_COUNTS, JOBS, run  # noqa: E402
from callstats.sinks.manifest import check_manifests  # noqa: E402
from callstats.session import build_session  # noqa: E402

# Default input file and output folder of the job scripts.
DEFAULT_INPUT = "/data/cdr_data.csv"
DEFAULT_OUTPUT = "/output"


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="callstats", description="Run one CDR batch job.")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("run_id", help="run id; empty or 'none' gives a UTC fallback id")
    p.add_argument("input_path", nargs="?", default=DEFAULT_INPUT)
    p.add_argument("--output-base", default=DEFAULT_OUTPUT)
    p.add_argument("--format", default=None, help="csv (default), parquet, json")
    p.add_argument("--input-count", choices=INPUT_COUNTS, default=None, help="exact by default")
    p.add_argument("--keep-rejects", action="store_true", help="write the rows the job cannot use beside the result")
    p.add_argument(
        "--declared-order",
        action="store_true",
        help="CSV files list the columns in the declared order: skip reading the header (one listing less)",
    )
    p.add_argument("--top", type=int, default=None, help="top_callers: number of callers (100)")
    p.add_argument("--k", type=float, default=None, help="anomalous_calls: sigmas (3)")
    p.add_argument("--strategy", choices=("auto", "split"), default=None, help="anomalous_calls")
    p.add_argument("--heavy-threshold", type=int, default=None, help="anomalous_calls (50000)")
    return p.parse_args(argv)


def job_params(args: argparse.Namespace) -> dict:
    params: dict = {"input_count": args.input_count} if args.input_count else {}
    if args.job == "top_callers" and args.top is not None:
        params["n"] = args.top
    if args.job == "anomalous_calls":
        for name in ("k", "strategy", "heavy_threshold"):
            if getattr(args, name) is not None:
                params[name] = getattr(args, name)
    return params


def check(argv: list[str]) -> list[dict]:
    """``check <output_base>``: one JSON line per run found under the base
    (manifest count, stored rows, ok); exits non-zero if any run is not ok."""
    p = argparse.ArgumentParser(prog="callstats check", description="Check every run's manifest against its output.")
    p.add_argument("output_base", nargs="?", default=DEFAULT_OUTPUT)
    p.add_argument("--job", default=None, choices=sorted(JOBS), help="only this job's runs")
    p.add_argument("--run-id", default=None, help="only runs with this id")
    args = p.parse_args(argv)
    spark = build_session("callstats-check")
    job_name = JOBS[args.job].job_name if args.job else None
    rows = []
    for r in check_manifests(spark, args.output_base, job_name, args.run_id).orderBy("job_name", "run_id").collect():
        rows.append(r.asDict())
        print(json.dumps(rows[-1]))
    if not rows or not all(r["ok"] for r in rows):
        raise SystemExit(1)
    return rows


def main(argv: list[str] | None = None) -> dict | list[dict]:
    argv = sys.argv[1:] if argv is None else argv
    if argv and argv[0] == "check":
        return check(argv[1:])
    args = parse_args(argv)
    spark = build_session(f"callstats-{args.job}")
    manifest = run(
        spark,
        args.job,
        args.input_path,
        args.output_base,
        args.run_id,
        fmt=args.format,
        by_header=not args.declared_order,
        keep_rejects=args.keep_rejects,
        **job_params(args),
    )
    print(json.dumps(manifest, indent=2))
    return manifest


if __name__ == "__main__":
    main()
