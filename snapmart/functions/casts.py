"""Strict and lenient casts and date parsing.

The strict forms raise on any non-null input that does not convert, whatever
the session's ANSI setting; the lenient forms turn bad input into null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.functions.util import as_col


def lenient_cast(value: Column | str, data_type: str) -> Column:
    """Bad input becomes null."""
    return as_col(value).try_cast(data_type)


def strict_cast(value: Column | str, data_type: str, label: str = "value") -> Column:
    """Bad non-null input raises ``label`` in the error message."""
    raw = as_col(value)
    converted = raw.try_cast(data_type)
    message = F.concat(
        F.lit(f"cannot cast {label} to {data_type}: '"), raw.cast("string"), F.lit("'")
    )
    return F.when(raw.isNotNull() & converted.isNull(), F.raise_error(message).cast(data_type)) \
        .otherwise(converted)


def parse_date(value: Column | str) -> Column:
    """Text (or timestamp) to DATE; bad text becomes null."""
    raw = as_col(value)
    return F.try_to_date(raw.cast("string"))


def strict_date(value: Column | str, label: str = "date") -> Column:
    """Text to DATE, raising on bad non-null input."""
    raw = as_col(value)
    parsed = F.try_to_date(raw.cast("string"))
    message = F.concat(F.lit(f"cannot parse {label}: '"), raw.cast("string"), F.lit("'"))
    return F.when(raw.isNotNull() & parsed.isNull(), F.raise_error(message).cast("date")) \
        .otherwise(parsed)


def strict_iso_date_text(value: Column | str, label: str = "date") -> Column:
    """Strictly parsed date kept as ``yyyy-MM-dd`` text (P10)."""
    return F.date_format(strict_date(value, label), "yyyy-MM-dd")
