"""The named batch jobs and the registered test-table queries."""

from callstats.plans.jobs import (
    JOBS,
    anomalous_calls,
    resolve_run_id,
    revenue_recon,
    run,
    run_job,
    top_callers,
    tower_heatmap,
)

__all__ = [
    "JOBS",
    "anomalous_calls",
    "resolve_run_id",
    "revenue_recon",
    "run",
    "run_job",
    "top_callers",
    "tower_heatmap",
]
