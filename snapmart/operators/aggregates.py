"""Grouped and global aggregates.

Floating-point sums depend on the order in which partitions are merged, so
two runs on different cluster layouts can differ in the last bit. Where the
inputs carry a fixed number of decimals, ``decimal_scale`` sums them exactly
in DECIMAL(38, scale). Rates have no such number: ``order_free_sum`` cuts each
double into whole numbers of falling weight, sums those, and puts the sums
together once at the end, so no value is rounded to a scale and no order shows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.util import as_col


#: Doubles below this size are summed in whole numbers; a part of a double has so many bits.
_LARGE = 2.0**62
_PART = 2.0**40


def order_free_sum(value: Column | str) -> Column:
    """``sum`` of doubles that is the same for every order and partition layout; null over no values.

    A value is its whole part and two parts of 40 bits below the point, each an integer and
    summed as one, so values down to 2**-27 in size enter with all their bits and smaller ones
    down to 2**-80. Values from 2**62 on, infinities and NaN are summed as doubles beside them.
    """
    x = as_col(value).cast("double")
    near = F.when(F.abs(x) < _LARGE, x)
    whole = near.cast("long")
    below = (near - whole.cast("double")) * _PART
    first = below.cast("long")
    second = ((below - first.cast("double")) * _PART).cast("long")

    def total(part: Column, digits: int) -> Column:
        return F.coalesce(F.sum(part.cast(f"decimal({digits},0)")).cast("double"), F.lit(0.0))

    far = F.coalesce(F.sum(F.when(~(F.abs(x) < _LARGE), x)), F.lit(0.0))
    return F.when(F.count(x) > 0, total(whole, 19) + (total(first, 13) / _PART + total(second, 13) / _PART**2) + far)


def exact_sum(value: Column | str, decimal_scale: int | None) -> Column:
    """``sum`` as double; exact in DECIMAL(38, scale) when a scale is given."""
    v = as_col(value)
    if decimal_scale is None:
        return F.sum(v.cast("double"))
    return F.sum(v.cast(f"decimal(38,{decimal_scale})")).cast("double")


def order_free_avg(value: Column | str) -> Column:
    """``avg`` ignoring nulls, of ``order_free_sum``."""
    return order_free_sum(value) / F.nullif(F.count(as_col(value)), F.lit(0))


def metric_summary(
    fact: DataFrame,
    group_by: Sequence[str] = ("metric", "year"),
    key_col: str = "entity_key",
    value_col: str = "value",
    yoy_col: str = "yoy_change_pct",
    five_year_col: str = "five_year_change_pct",
    decimal_scale: int | None = None,
) -> DataFrame:
    """Per (metric, year): rows, distinct entities, total, mean growth rates.

    ``decimal_scale`` is that of the total; the means are taken over plain doubles.

    ``count(DISTINCT key)`` is planned by Spark as a two-level aggregation
    (group+key first), so no single task sees all keys of a big group.
    """
    return fact.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("source_records"),
        F.countDistinct(key_col).alias("entities"),
        exact_sum(value_col, decimal_scale).alias("snapshot_total"),
        order_free_avg(yoy_col).alias("average_yoy_change_pct"),
        order_free_avg(five_year_col).alias("average_five_year_change_pct"),
    )


def rows_per_group(df: DataFrame, group_col: str, count_col: str = "rows") -> DataFrame:
    """Row count per group, e.g. per dataset or table."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias(count_col))


def global_extrema(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """One-row min/max of each column (A7). Safe to broadcast: always one row."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{prefix}{c}__min"), F.max(c).alias(f"{prefix}{c}__max")]
    return df.agg(*aggs)


def floor_max(df: DataFrame, column: str, floor: float = 1.0, alias: str = "scale_max") -> DataFrame:
    """One-row ``max(max(column), floor)`` for relative scaling."""
    return df.agg(F.greatest(F.max(F.col(column).cast("double")), F.lit(floor)).alias(alias))
