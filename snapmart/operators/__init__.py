"""DataFrame operators: dedupe, quality, upsert, aggregates, rankings, marts."""

from snapmart.operators.aggregates import exact_sum, metric_summary, order_free_avg, order_free_sum, rows_per_group
from snapmart.operators.dedupe import duplicate_rows, keep_any, keep_first, keep_last
from snapmart.operators.marts import (
    ACTIVITY_MART,
    ENERGY_MART,
    MartSpec,
    MetricSpec,
    build_dimension,
    build_fact,
    build_mart,
)
from snapmart.operators.quality import enforce_gate, quality_report, snapshot_rules
from snapmart.operators.ranking import dense_rank_by, top_k
from snapmart.operators.standardize import lake_silver, standardize
from snapmart.operators.upsert import key_bucket, upsert

__all__ = [
    "ACTIVITY_MART",
    "ENERGY_MART",
    "MartSpec",
    "MetricSpec",
    "build_dimension",
    "build_fact",
    "build_mart",
    "dense_rank_by",
    "duplicate_rows",
    "enforce_gate",
    "exact_sum",
    "keep_any",
    "keep_first",
    "keep_last",
    "key_bucket",
    "lake_silver",
    "metric_summary",
    "order_free_avg",
    "order_free_sum",
    "quality_report",
    "rows_per_group",
    "snapshot_rules",
    "standardize",
    "top_k",
    "upsert",
]
