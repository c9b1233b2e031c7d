"""Clean the text columns of large tables and show what the cleaning changed."""

from scrublens.operators.columns import ColumnSpec
from scrublens.plans.job import JobResult, JobSpec, Options, clean, run_job

__all__ = ["ColumnSpec", "JobResult", "JobSpec", "Options", "clean", "run_job"]
