"""Parameters of the two analyses, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskConfig:
    """Parameters of the risk model.

    condition        text to look for in the condition column
    num_conditions   number of comorbid conditions used as features
    num_days         length of the look-back window, in days
    num_days_future  length of the look-ahead window of the label, in days
    """

    condition: str = "drug overdose"
    num_conditions: int = 10
    num_days: int = 90
    num_days_future: int = 10

    def __post_init__(self):
        if not self.condition:
            raise ValueError("condition must not be empty")
        if self.num_conditions < 1 or self.num_days < 1 or self.num_days_future < 0:
            raise ValueError(f"window and condition counts out of range: {self}")

    @property
    def model_name(self) -> str:
        return "-".join(self.condition.split())


@dataclass(frozen=True)
class DashboardConfig:
    """Parameters of the prevalence and association reports."""

    num_conditions: int = 20
    first_condition: str = "chronic pain"
    second_condition: str = "drug overdose"
