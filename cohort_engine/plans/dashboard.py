"""Prevalence and association reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohort_engine.config import DashboardConfig
from cohort_engine.operators import stats


def dashboard(
    patient_encounters: DataFrame, patients: DataFrame, config: DashboardConfig | None = None
) -> dict[str, DataFrame]:
    """All reports by name, each lazy."""
    config = config or DashboardConfig()
    k, first, second = config.num_conditions, config.first_condition, config.second_condition
    return {
        "top_by_encounters": stats.top_conditions(patient_encounters, k, by="encounters"),
        "top_by_patients": stats.top_conditions(patient_encounters, k, by="patients"),
        "selected_conditions": stats.condition_counts(patient_encounters, [first, second]),
        "comorbid_conditions": stats.comorbid_conditions(patient_encounters, first, k),
        "association": association(patient_encounters, patients, first, second),
    }


def association(
    patient_encounters: DataFrame,
    patients: DataFrame,
    first: str,
    second: str,
    correction: bool = True,
) -> DataFrame:
    """Chi-squared test of two conditions over all patients, one row."""
    pairs = stats.co_occurrence(patients, patient_encounters, first, second)
    return stats.chi_square(stats.contingency(pairs, first, second), correction)
