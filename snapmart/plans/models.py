"""The SQL serving models over the long fact.

The published project builds a staging view over the gold fact, a metric
summary and per-metric rankings, and declares not-null / accepted-values
tests on them. Here they are plain DataFrame functions named by a
:class:`~snapmart.operators.marts.MartSpec`, so the same code serves the
energy snapshot and the activity snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.operators import quality as q
from snapmart.operators.aggregates import metric_summary
from snapmart.operators.marts import MartSpec
from snapmart.operators.ranking import dense_rank_by


def staging(fact: DataFrame, spec: MartSpec) -> DataFrame:
    """Typed staging view of the fact: trimmed name, integer year, double
    value and rates (C9, F4, P12)."""
    return fact.select(
        spec.key_col,
        F.trim(spec.name_col).alias(spec.name_col),
        F.col("year").cast("int").alias("year"),
        "metric",
        F.col("value").cast("double").alias("value"),
        "unit",
        F.col("yoy_change_pct").cast("double").alias("yoy_change_pct"),
        F.col("five_year_change_pct").cast("double").alias("five_year_change_pct"),
    )


def summary(stg: DataFrame, spec: MartSpec, decimal_scale: int | None = None) -> DataFrame:
    """Per (metric, year) counts, distinct entities, totals, mean rates."""
    return metric_summary(stg, key_col=spec.key_col, decimal_scale=decimal_scale)


def rankings(stg: DataFrame, spec: MartSpec) -> DataFrame:
    """Dense rank of the value per metric, largest first."""
    cols = stg.select(spec.key_col, spec.name_col, "metric", "year", "value", "yoy_change_pct")
    return dense_rank_by(cols, ["metric"], "value", rank_col="snapshot_rank")


def model_tests(
    stg: DataFrame, summary_df: DataFrame, rankings_df: DataFrame, spec: MartSpec
) -> DataFrame:
    """The declared model tests (Q9, Q10) as one report: not-null key, metric
    and value on staging, accepted metric values, not-null metric on the
    summary and not-null rank on the rankings."""
    metrics = [m.metric for m in spec.metrics]
    return q.quality_report(
        {"stg": stg, "metric_summary": summary_df, "rankings": rankings_df},
        {
            "stg": [q.column_not_null(spec.key_col), q.column_not_null("metric"),
                    q.accepted_values("metric", metrics), q.column_not_null("value")],
            "metric_summary": [q.column_not_null("metric")],
            "rankings": [q.column_not_null("snapshot_rank")],
        },
    )
