"""Tail probability of the chi-squared distribution with one degree of freedom."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms of the series, and steps of the continued fraction; enough for doubles on both
# sides of the bound between them.
_TERMS, _STEPS, _BOUND = 60, 300, 2.0


def chi_square_log_p(statistic: str | Column) -> Column:
    """Natural logarithm of P(X >= statistic), df = 1; null stays null.

    The probability is erfc(z), z = sqrt(statistic / 2). For small z it is 1 minus the
    series of erf, for large z the continued fraction of erfc, whose logarithm is found
    without the value itself: it is right where the probability is too small for a double.
    """
    x = F.col(statistic) if isinstance(statistic, str) else statistic
    z = F.sqrt(F.greatest(x, F.lit(0.0)) / 2)
    # exp(-z^2) * sum of 2^k z^(2k+1) / (1 * 3 * ... * (2k+1)): positive terms only.
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_TERMS)),
        F.struct(z.alias("sum"), z.alias("term")),
        lambda s, k: F.struct(
            (s["sum"] + s["term"] * 2 * z * z / (2 * k + 1)).alias("sum"),
            (s["term"] * 2 * z * z / (2 * k + 1)).alias("term"),
        ),
    )["sum"]
    erf = F.exp(-z * z) * series * (2 / math.sqrt(math.pi))
    fraction = F.aggregate(
        F.sequence(F.lit(_STEPS), F.lit(1), F.lit(-1)), z, lambda t, k: z + k / 2 / t
    )
    tail = -z * z - F.log(fraction * math.sqrt(math.pi))
    return F.when(x.isNotNull(), F.when(z < _BOUND, F.log1p(-erf)).otherwise(tail))


def chi_square_p_value(statistic: str | Column) -> Column:
    """P(X >= statistic), df = 1; 0 where it is too small for a double."""
    return F.exp(chi_square_log_p(statistic))
