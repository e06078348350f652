"""Prevalence, comorbidity and association of conditions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.functions.significance import chi_square_log_p
from cohort_engine.functions.text import matches
from cohort_engine.operators.cohorts import CONDITION, cases

NONE = "none"


def condition_counts(
    encounters: DataFrame, conditions: Sequence[str] | None = None, literal: bool = False
) -> DataFrame:
    """Encounters per condition text; with ``conditions`` only the texts that
    mention at least one of them."""
    if conditions:
        kept = reduce(
            lambda a, b: a | b, (matches(CONDITION, c, literal) for c in conditions)
        )
    else:
        kept = F.col(CONDITION).isNotNull()
    return encounters.filter(kept).groupBy(CONDITION).agg(F.count(F.lit(1)).alias("count"))


def patient_counts(encounters: DataFrame) -> DataFrame:
    """Distinct patients per condition text."""
    return _count_patients(_patient_conditions(encounters))


def top_conditions(encounters: DataFrame, k: int = 20, by: str = "encounters") -> DataFrame:
    """The ``k`` most frequent conditions, by ``encounters`` or by ``patients``."""
    counters = {"encounters": condition_counts, "patients": patient_counts}
    if by not in counters:
        raise ValueError(f"by must be one of {sorted(counters)}, not {by!r}")
    return _top(counters[by](encounters), k)


def comorbid_conditions(
    encounters: DataFrame,
    condition: str,
    k: int = 20,
    exclude_index: bool = True,
    literal: bool = False,
    paired: bool = False,
) -> DataFrame:
    """The ``k`` conditions most patients with ``condition`` also have.

    ``exclude_index`` leaves out the texts that mention the condition itself. ``paired``
    says that no two of the encounters have the same patient and condition.
    """
    # Encounters are reduced to (patient, condition text) pairs before the join, so
    # that only pairs are shuffled by patient. A semi join, because AQE can split it.
    pairs = encounters.filter(F.col(CONDITION).isNotNull()).select("PATIENT", CONDITION)
    pairs = pairs if paired else pairs.distinct()
    if exclude_index:
        pairs = pairs.filter(~matches(CONDITION, condition, literal))
    studied = cases(encounters, condition, literal).select("PATIENT")
    return _top(_count_patients(pairs.join(studied, ["PATIENT"], "left_semi")), k)


def co_occurrence(
    patients: DataFrame, encounters: DataFrame, a: str, b: str, literal: bool = False
) -> DataFrame:
    """One row (PATIENT, first, second) per patient: the condition's name or 'none'.

    Patients without any encounter count as having neither.
    """
    is_a, is_b = matches(CONDITION, a, literal), matches(CONDITION, b, literal)
    found = (
        encounters.filter(is_a | is_b)
        .groupBy("PATIENT")
        .agg(F.max(is_a).alias("has_a"), F.max(is_b).alias("has_b"))
    )
    return (
        patients.select("PATIENT")
        .join(found, ["PATIENT"], "left")
        .select(
            "PATIENT",
            F.when(F.col("has_a"), F.lit(a)).otherwise(F.lit(NONE)).alias("first"),
            F.when(F.col("has_b"), F.lit(b)).otherwise(F.lit(NONE)).alias("second"),
        )
    )


def contingency(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """2x2 table of ``co_occurrence`` as four rows (first, second, patients).

    One aggregation with four conditional counts, so empty cells show up as 0.
    """
    cells = [(x, y) for x in (a, NONE) for y in (b, NONE)]
    counts = pairs.agg(
        *[
            F.count_if((F.col("first") == x) & (F.col("second") == y)).alias(f"n{i}")
            for i, (x, y) in enumerate(cells)
        ]
    )
    rows = [
        F.struct(F.lit(x).alias("first"), F.lit(y).alias("second"), F.col(f"n{i}").alias("patients"))
        for i, (x, y) in enumerate(cells)
    ]
    return counts.select(F.inline(F.array(*rows)))


def chi_square(table: DataFrame, correction: bool = True) -> DataFrame:
    """Test of association on a 2x2 ``contingency`` table, one row:
    (statistic, df, p_value, log10_p, verdict).

    ``correction`` is Yates' continuity correction. When a margin is zero, nothing
    can be tested: statistic and p-value are null. ``log10_p`` tells apart p-values that
    are too small for a double.
    """
    has_a, has_b = F.col("first") != NONE, F.col("second") != NONE

    def cell(kept):
        return F.coalesce(F.sum(F.when(kept, F.col("patients"))), F.lit(0)).cast("double")

    n11, n12, n21, n22 = F.col("n11"), F.col("n12"), F.col("n21"), F.col("n22")
    total = n11 + n12 + n21 + n22
    margins = (n11 + n12) * (n21 + n22) * (n11 + n21) * (n12 + n22)
    # |observed - expected| is the same in all four cells of a 2x2 table.
    gap = F.try_divide(F.abs(n11 * n22 - n12 * n21), total)
    used = gap - F.least(F.lit(0.5), gap) if correction else gap
    p = F.col("p_value")
    return (
        table.agg(
            cell(has_a & has_b).alias("n11"),
            cell(has_a & ~has_b).alias("n12"),
            cell(~has_a & has_b).alias("n21"),
            cell(~has_a & ~has_b).alias("n22"),
        )
        .select(F.try_divide(used * used * total * total * total, margins).alias("statistic"))
        .select("statistic", F.lit(1).alias("df"), chi_square_log_p("statistic").alias("log_p"))
        .select(
            "statistic",
            "df",
            F.exp("log_p").alias("p_value"),
            (F.col("log_p") / math.log(10)).alias("log10_p"),
        )
        .withColumn(
            "verdict",
            F.when(p < 1e-10, F.lit("highly significant"))
            .when(p < 0.05, F.lit("significant"))
            .when(p.isNotNull(), F.lit("not significant"))
            .otherwise(F.lit("not testable")),
        )
    )


def _patient_conditions(encounters):
    return encounters.filter(F.col(CONDITION).isNotNull()).select("PATIENT", CONDITION).distinct()


def _count_patients(pairs):
    return pairs.groupBy(CONDITION).agg(F.count(F.lit(1)).alias("count"))


def _top(counts, k):
    # Equal counts are ordered by name, so that the k-th place is well defined.
    return counts.orderBy(F.col("count").desc(), F.col(CONDITION)).limit(k)
