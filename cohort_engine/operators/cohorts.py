"""Cases, controls and the encounters of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.functions.hashing import hash_order
from cohort_engine.functions.text import matches
from cohort_engine.operators.sampling import hash_cutoff, row_count, take_by_hash

CONDITION = "REASONDESCRIPTION"


def cases(encounters: DataFrame, condition: str, literal: bool = False) -> DataFrame:
    """Distinct patients with at least one encounter that mentions the condition."""
    return (
        encounters.filter(matches(CONDITION, condition, literal))
        .select("PATIENT")
        .distinct()
        .withColumn("is_positive", F.lit(True))
    )


def non_cases(encounters: DataFrame, cases: DataFrame) -> DataFrame:
    """Distinct patients that are not in ``cases``."""
    # Both sides are reduced to one row per patient before they meet, so a patient
    # with very many encounters weighs as much as any other.
    return (
        encounters.select("PATIENT")
        .distinct()
        .join(cases.select("PATIENT"), ["PATIENT"], "left_anti")
    )


def controls(
    encounters: DataFrame,
    cases: DataFrame | str,
    n: int | None = None,
    seed: str | int | None = None,
    literal: bool = False,
) -> DataFrame:
    """As many patients without the condition as there are cases (or ``n``).

    ``cases`` is the condition, or a table of cases. With the condition, as in
    ``case_control``, one aggregation by patient answers "case or not" for everybody.
    The choice is by md5 of the patient id: random-like, yet the same in each run. All
    patients without the condition are returned when there are fewer.
    """
    if not isinstance(cases, str):
        others = non_cases(encounters, cases).withColumn("is_positive", F.lit(False))
        wanted = row_count(cases) if n is None else F.lit(n)
        return take_by_hash(others, "PATIENT", wanted, seed)
    status = patient_status(encounters, cases, literal)
    cutoff = hash_cutoff(status, "PATIENT", n, seed, among=~F.col("is_positive"))
    # As one comparison with the status in it, which can't be moved below the aggregation:
    # its result then serves the cutoff as well. "h" is above all cutoffs.
    place = F.when(F.col("is_positive"), F.lit("h")).otherwise(hash_order("PATIENT", seed))
    return status.filter(place <= cutoff)


def case_control(
    encounters: DataFrame, condition: str, seed: str | int | None = None, literal: bool = False
) -> DataFrame:
    """``cases`` and an equal number of ``controls`` in one pass over the encounters.

    One aggregation by patient answers "case or not" for everybody; the union of
    both groups is then a filter on it.
    """
    status = patient_status(encounters, condition, literal)
    cutoff = hash_cutoff(status, "PATIENT", seed=seed, among=~F.col("is_positive"))
    return status.filter(F.col("is_positive") | (hash_order("PATIENT", seed) <= cutoff))


def patient_status(encounters: DataFrame, condition: str, literal: bool = False) -> DataFrame:
    """(PATIENT, is_positive) for every patient with an encounter."""
    return encounters.groupBy("PATIENT").agg(
        F.coalesce(F.max(matches(CONDITION, condition, literal)), F.lit(False)).alias(
            "is_positive"
        )
    )


def qualified_encounters(encounters: DataFrame, cohort: DataFrame) -> DataFrame:
    """Encounters of the cohort's patients that have a DESCRIPTION.

    The cohort grows with the data, so it is not hinted as broadcast; Spark decides
    by its size and AQE splits patients with a large share of the encounters.
    """
    return encounters.filter(F.col("DESCRIPTION").isNotNull()).join(cohort, ["PATIENT"])
