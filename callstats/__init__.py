"""callstats: batch analytics over call detail records on Spark DataFrames."""

from callstats.plans.jobs import JOBS, run, run_job
from callstats.schema import CDR_ROLES, CDR_SCHEMA, Roles
from callstats.session import build_session, shared_dir

__all__ = ["CDR_ROLES", "CDR_SCHEMA", "JOBS", "Roles", "build_session", "run", "run_job", "shared_dir"]
