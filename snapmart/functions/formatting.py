"""Human-readable number formats for report extracts.

``format_number`` rounds the exact binary value half-even, like Python's
``format``; ``format_string('%.2f')`` would not (2.675 -> 2.68).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.functions.util import as_col

# Thresholds and suffixes of the volume format, and the decimals
# shown per branch (billions and millions 2, thousands 1, else grouped integer).
VOLUME_STEPS = ((1_000_000_000.0, "B", 2), (1_000_000.0, "M", 2), (1_000.0, "K", 1))


def _plain(value: Column, decimals: int) -> Column:
    """Fixed decimals without grouping separators."""
    return F.regexp_replace(F.format_number(value, decimals), ",", "")


def grouped_integer(value: Column | str) -> Column:
    """``1234567.4`` -> ``1,234,567``."""
    return F.format_number(as_col(value).cast("double"), 0)


def fixed_decimals(value: Column | str, decimals: int = 2) -> Column:
    """``-6.6899`` -> ``-6.69`` with no grouping."""
    return _plain(as_col(value).cast("double"), decimals)


def humanize_volume(value: Column | str) -> Column:
    """``3.1e6`` -> ``3.10M``; below 1,000 (and negatives) a grouped integer."""
    v = as_col(value).cast("double")
    expr = None
    for threshold, suffix, decimals in VOLUME_STEPS:
        text = F.concat(_plain(v / F.lit(threshold), decimals), F.lit(suffix))
        expr = F.when(v >= threshold, text) if expr is None else expr.when(v >= threshold, text)
    return expr.otherwise(F.format_number(v, 0))
