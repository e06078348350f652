"""Cohort and risk analytics on event histories, written for Spark.

Every operator takes DataFrames and returns a lazy DataFrame. The few functions
which run a job while they build a plan say so in their docstring.
"""

from cohort_engine.config import DashboardConfig, RiskConfig
from cohort_engine.session import scratch_dir, tune_session
from cohort_engine.sources.dataset import CohortDataset

__all__ = [
    "CohortDataset",
    "DashboardConfig",
    "RiskConfig",
    "scratch_dir",
    "tune_session",
]
