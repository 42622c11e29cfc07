"""Serving extracts over the mart and fact.

Every list here is a top-k (k is the feature: 10, 8, 3, 1, 20 rows), planned
as ``WindowGroupLimit`` / ``TakeOrderedAndProject`` so each map task forwards
at most k rows per list; one-row documents come from a single aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.functions.formatting import fixed_decimals, grouped_integer, humanize_volume
from snapmart.functions.numeric import relative_width
from snapmart.operators.aggregates import exact_sum
from snapmart.operators.marts import MartSpec
from snapmart.operators.quality import FAIL
from snapmart.operators.ranking import top_k, with_position
from snapmart.sources.sinks import publish_views


def _by_metric(mart: DataFrame, spec: MartSpec) -> DataFrame:
    """The mart unpivoted to (metric, entity, value, rates, score): one row per
    entity and metric, no shuffle (an ``explode`` of a 3-element array)."""
    entries = [
        F.struct(
            F.lit(m.metric).alias("metric"),
            F.col(m.value_column).cast("double").alias("value"),
            F.col(m.yoy_column).alias("yoy_pct"),
            F.col(m.five_year_column).alias("five_year_pct"),
        )
        for m in spec.metrics
    ]
    return mart.select(
        spec.key_col, spec.name_col, spec.score_col, F.explode(F.array(*entries)).alias("m")
    ).select(spec.key_col, spec.name_col, spec.score_col, "m.*")


def _list_order(spec: MartSpec, value: str = "value", descending: bool = True) -> list[Column]:
    """Value, then the mart's own order (score desc, name, key) as tie-break."""
    v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return [
        v,
        F.col(spec.score_col).desc_nulls_last(),
        F.col(spec.name_col).asc_nulls_last(),
        F.col(spec.key_col).asc_nulls_last(),
    ]


def top_by_metric(mart: DataFrame, spec: MartSpec, k: int = 10) -> DataFrame:
    """Top-k entities per metric with their rates (O5; k=8 gives O7, k=1 O6)."""
    long = _by_metric(mart, spec)
    return top_k(long, k, _list_order(spec), partition_by=["metric"]).select(
        "metric", "position", spec.key_col, spec.name_col, "value", "yoy_pct", "five_year_pct"
    )


def top_labels(mart: DataFrame, spec: MartSpec) -> DataFrame:
    """One row: the leading entity name per metric (O6), via ``min_by`` per
    metric column inside one aggregation (no sort)."""
    aggs = []
    for m in spec.metrics:
        order = F.struct(
            (-F.col(m.value_column).cast("double")).alias("v"),
            (-F.col(spec.score_col)).alias("s"),
            F.col(spec.name_col).alias("n"),
            F.col(spec.key_col).alias("k"),
        )
        aggs.append(F.min_by(spec.name_col, order).alias(f"top_{m.prefix}_{spec.name_col}"))
    return mart.agg(*aggs)


def momentum_extremes(mart: DataFrame, spec: MartSpec, k: int = 3) -> DataFrame:
    """Strongest growth and largest declines of the combined rate, nulls dropped."""
    rated = mart.dropna(subset=[spec.combined_col]).select(
        spec.key_col, spec.name_col, spec.score_col, F.col(spec.combined_col).alias("value")
    )
    both = rated.select("*", F.explode(F.array(F.lit("growth"), F.lit("decline"))).alias("list"))
    signed = both.withColumn(
        "__v", F.when(F.col("list") == "growth", F.col("value")).otherwise(-F.col("value"))
    )
    ranked = top_k(signed, k, _list_order(spec, "__v"), partition_by=["list"])
    return ranked.select(
        "list",
        "position",
        spec.key_col,
        spec.name_col,
        "value",
        F.concat(humanize_volume("value"), F.lit("%")).alias("label"),
    )


def findings(mart: DataFrame, spec: MartSpec, k: int = 3, decimal_scale: int | None = None):
    """The findings extract (C12): leading entities per metric, strongest
    growth and largest declines, and snapshot totals, each as a display label.

    One row per line: (section, position, entity, label); totals have no entity.
    """
    tops = top_by_metric(mart, spec, k).select(
        F.concat(F.lit("top_"), F.col("metric")).alias("section"),
        "position",
        F.col(spec.name_col).alias("entity"),
        humanize_volume("value").alias("label"),
    )
    moves = momentum_extremes(mart, spec, k).select(
        F.col("list").alias("section"), "position", F.col(spec.name_col).alias("entity"), "label"
    )
    totals = _by_metric(mart, spec).groupBy("metric").agg(
        exact_sum("value", decimal_scale).alias("total")
    ).select(
        F.concat(F.lit("total_"), F.col("metric")).alias("section"),
        F.lit(1).cast("long").alias("position"),
        F.lit(None).cast("string").alias("entity"),
        humanize_volume("total").alias("label"),
    )
    return tops.unionByName(moves).unionByName(totals)


def momentum_ranking(mart: DataFrame, spec: MartSpec) -> DataFrame:
    """All entities with a combined rate, with their position in ascending order."""
    rated = mart.dropna(subset=[spec.combined_col]).select(
        spec.key_col, spec.name_col, spec.combined_col, spec.class_col
    )
    order = [F.col(c).asc_nulls_last() for c in (spec.combined_col, spec.name_col, spec.key_col)]
    return with_position(rated, order)


#: Sign of change -> condition on the combined rate (P20).
_CHANGES = {
    "growth": lambda rate: rate > 0,
    "decline": lambda rate: rate < 0,
    "unchanged": lambda rate: rate == 0,
    "unknown": lambda rate: rate.isNull(),
}


def dashboard_filter(
    spec: MartSpec, entities: Sequence[str] = (), classes: Sequence[str] = (),
    with_metrics: Sequence[str] = (), change: str | None = None,
) -> Column:
    """The dashboard's filters as one condition on the mart (P20).

    Entity names, activity classes, metrics that must be present, and the sign of
    the combined change (``growth``, ``decline``, ``unchanged`` or ``unknown``). An
    empty filter lets every row pass; a null never meets a filter that is set.
    """
    unknown = set(with_metrics) - {m.metric for m in spec.metrics}
    if unknown:
        raise ValueError(f"the mart has no metric {sorted(unknown)}")
    met = F.lit(True)
    if entities:
        met &= F.col(spec.name_col).isin(list(entities))
    if classes:
        met &= F.col(spec.class_col).isin(list(classes))
    for m in spec.metrics:
        if m.metric in with_metrics:
            met &= F.col(m.value_column).isNotNull()
    if change:
        met &= _CHANGES[change](F.col(spec.combined_col))
    return F.coalesce(met, F.lit(False))


def mart_head(mart: DataFrame, spec: MartSpec, n: int = 20) -> DataFrame:
    """The first ``n`` rows of the ordered mart with table formats."""
    head = top_k(mart, n, _list_order(spec, spec.score_col)[1:], partition_by=[])
    cols = [F.col("position"), F.col(spec.key_col), F.col(spec.name_col)]
    cols += [grouped_integer(m.value_column).alias(f"{m.value_column}_text") for m in spec.metrics]
    cols += [
        fixed_decimals(spec.combined_col).alias(f"{spec.combined_col}_text"),
        fixed_decimals(spec.score_col).alias(f"{spec.score_col}_text"),
    ]
    return head.select(*cols)


def dashboard_bars(mart: DataFrame, spec: MartSpec, k: int = 8) -> DataFrame:
    """Top-k bars per metric: width relative to the list's maximum (floored at
    1.0) and a humanized label (O7, F10, F11, A11). The maximum of a top-k list
    is its first row, so no extra aggregation runs."""
    bars = top_by_metric(mart, spec, k)
    # same partitioning as the top-k window: no extra shuffle, k rows per list
    with_max = bars.withColumn(
        "__max", F.greatest(F.max("value").over(Window.partitionBy("metric")), F.lit(1.0))
    )
    return with_max.select(
        "metric",
        "position",
        spec.key_col,
        spec.name_col,
        "value",
        relative_width("value", "__max").alias("width_pct"),
        humanize_volume("value").alias("label"),
    )


def snapshot_metrics(
    fact: DataFrame, mart: DataFrame, report: DataFrame, spec: MartSpec,
    decimal_scale: int | None = None,
) -> DataFrame:
    """The one-row metrics document (C6, A2-A5): record counts, entity count,
    totals, check totals and the leading names. Three one-row aggregations;
    they are combined by :func:`one_row` (no join)."""
    f = fact.agg(
        F.count(F.lit(1)).alias("source_records"),
        *[F.count_if(F.col("metric") == m.metric).alias(f"{m.prefix}_records")
          for m in spec.metrics],
    )
    mart_aggs = [F.countDistinct(spec.key_col).alias("entities")]
    mart_aggs += [exact_sum(m.value_column, decimal_scale).alias(f"snapshot_{m.prefix}")
                  for m in spec.metrics]
    for m in spec.metrics:
        order = F.struct(
            (-F.col(m.value_column).cast("double")).alias("v"),
            (-F.col(spec.score_col)).alias("s"),
            F.col(spec.name_col).alias("n"),
            F.col(spec.key_col).alias("k"),
        )
        mart_aggs.append(F.min_by(spec.name_col, order).alias(f"top_{m.prefix}_entity"))
    g = mart.agg(*mart_aggs)
    r = report.agg(
        F.count(F.lit(1)).alias("quality_checks"),
        F.count_if(F.col("status") == FAIL).alias("quality_failures"),
    )
    return one_row(f, g, r)


def one_row(*rows: DataFrame) -> DataFrame:
    """Combine one-row aggregates with distinct columns into one row.

    The rows are unioned (each carrying nulls for the others' columns) and
    collapsed by one more aggregation over those few rows: no join, no
    cross product, and each input aggregate runs once.
    """
    stacked = rows[0]
    for r in rows[1:]:
        stacked = stacked.unionByName(r, allowMissingColumns=True)
    columns = [c for r in rows for c in r.columns]
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])


def serving_top(spark: SparkSession, mart: DataFrame, spec: MartSpec, view: str, n: int = 10):
    """Publish the mart as a view and run the documented serving query."""
    publish_views(spark, {view: mart})
    value_cols = ", ".join(m.value_column for m in spec.metrics)
    return spark.sql(
        f"SELECT {spec.name_col}, {value_cols} FROM {view} "
        f"ORDER BY {spec.score_col} DESC, {spec.name_col}, {spec.key_col} LIMIT {n}"
    )


def table_row_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as one frame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
