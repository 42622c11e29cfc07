"""Guarded arithmetic used by the scored mart.

ANSI mode raises on division by zero, so every division is behind a guard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.functions.util import as_col

# Fixed values of the momentum classes: upper-inclusive bins
# (-inf, -5], (-5, 5], (5, inf) and the label for a missing rate.
MOMENTUM_LOWER = -5.0
MOMENTUM_UPPER = 5.0
MOMENTUM_DECLINING = "Declining"
MOMENTUM_STABLE = "Stable"
MOMENTUM_EXPANDING = "Expanding"
MOMENTUM_NOT_COMPARABLE = "Not comparable"


def prior_estimate(current: Column | str, percent_change: Column | str) -> Column:
    """Value before a ``percent_change``: ``x / (1 + p/100)``.

    A divisor of exactly 0 (p = -100) keeps ``x``; a null rate gives null.
    """
    x = as_col(current)
    divisor = F.lit(1) + as_col(percent_change) / F.lit(100.0)
    return F.when(divisor == 0, x).otherwise(x / divisor)


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``a / b`` when ``b > 0``, else null."""
    b = as_col(denominator)
    return F.when(b > 0, as_col(numerator) / b)


def row_mean(*columns: Column | str) -> Column:
    """Mean of the non-null arguments, null when all are null."""
    cols = [as_col(c).cast("double") for c in columns]
    total = F.coalesce(cols[0], F.lit(0.0))
    present = F.when(cols[0].isNotNull(), 1).otherwise(0)
    for c in cols[1:]:
        total = total + F.coalesce(c, F.lit(0.0))
        present = present + F.when(c.isNotNull(), 1).otherwise(0)
    return F.when(present > 0, total / present)


def momentum_class(rate: Column | str) -> Column:
    """Bucketize a growth rate into the momentum labels."""
    r = as_col(rate)
    return (
        F.when(r.isNull(), F.lit(MOMENTUM_NOT_COMPARABLE))
        .when(r <= MOMENTUM_LOWER, F.lit(MOMENTUM_DECLINING))
        .when(r <= MOMENTUM_UPPER, F.lit(MOMENTUM_STABLE))
        .otherwise(F.lit(MOMENTUM_EXPANDING))
    )


def log_activity(value: Column | str) -> Column:
    """``log1p`` of the value with null and negatives taken as 0 (first half of F8)."""
    return F.log1p(F.greatest(F.coalesce(as_col(value).cast("double"), F.lit(0.0)), F.lit(0.0)))


def min_max_scaled(logged: Column | str, low: Column | str, high: Column | str) -> Column:
    """``(x - min) / (max - min)``; a constant column (spread 0) scales to 0 (F8)."""
    spread = as_col(high) - as_col(low)
    return F.when(spread == 0, F.lit(0.0)).otherwise((as_col(logged) - as_col(low)) / spread)


def round_half_even(value: Column | str, digits: int = 2) -> Column:
    """Round to ``digits`` decimals, ties to even, as NumPy does.

    ``rint(x * 10^d) / 10^d``; Spark's ``round`` would round 0.125 up to 0.13.
    """
    scale = float(10**digits)
    return F.rint(as_col(value) * F.lit(scale)) / F.lit(scale)


def relative_width(value: Column | str, maximum: Column | str, floor: float = 1.0) -> Column:
    """Bar width in percent: ``max(floor, 100 * v / max)``."""
    return F.greatest(F.lit(floor), F.lit(100.0) * as_col(value) / as_col(maximum))


def percent_change(current: Column | str, prior: Column | str) -> Column:
    """``100 * (cur - prior) / prior``; null without a (non-zero) prior."""
    p = as_col(prior)
    return F.when(p != 0, F.lit(100.0) * (as_col(current) - p) / p)
