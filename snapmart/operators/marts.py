"""Gold layer: dimension, long fact and the wide scored mart.

The mart is configured by a :class:`MartSpec` (metric names, reference years,
weights, column names), so the same operator serves the published energy
snapshot and the activity snapshot derived from the driver tables.

Two equivalent strategies build the wide rows:

* ``"join"`` (J1): dimension left-joined with one slice per metric on the
  entity key. All joins share the key, so after the first exchange the
  partitioning is reused and each slice is shuffled once. Exactly like the
  published pipeline it fans out when a key has several rows for one metric.
* ``"aggregate"``: a single ``groupBy(key)`` with one conditional ``max`` per
  metric: one shuffle, map-side combined. It equals ``"join"`` whenever each
  key has at most one row per metric and reference year (true after
  de-duplication on the key), and picks one whole row otherwise.

Scaling needs global extrema; they come from one aggregation whose single row
is applied as literals (computed once), never from an unpartitioned window.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions.numeric import (
    guarded_ratio,
    log_activity,
    min_max_scaled,
    momentum_class,
    prior_estimate,
    round_half_even,
    row_mean,
)

FACT_COLUMNS_TEMPLATE = ("year", "metric", "value", "unit", "yoy_change_pct", "five_year_change_pct")


@dataclass(frozen=True)
class MetricSpec:
    metric: str  # value of the ``metric`` column
    prefix: str  # stem of the year / rate columns
    year: int  # reference year kept in the mart
    weight: float  # weight in the activity score
    stem: str | None = None  # stem of value / estimate / ratio columns (default: prefix)
    estimates: bool = False  # add prior-year and five-years-prior estimates
    momentum: bool = False  # its yoy rate feeds the combined momentum
    per_unit: bool = False  # divided by the denominator metric

    @property
    def value_stem(self) -> str:
        return self.stem or self.prefix

    @property
    def value_column(self) -> str:
        return f"{self.value_stem}_{self.year}"

    @property
    def year_column(self) -> str:
        return f"{self.prefix}_year"

    @property
    def yoy_column(self) -> str:
        return f"{self.prefix}_yoy_pct"

    @property
    def five_year_column(self) -> str:
        return f"{self.prefix}_five_year_pct"

    @property
    def prior_year_estimate(self) -> str:
        return f"{self.value_stem}_{self.year - 1}_estimated"

    @property
    def five_year_estimate(self) -> str:
        return f"{self.value_stem}_{self.year - 5}_estimated"


@dataclass(frozen=True)
class MartSpec:
    metrics: tuple[MetricSpec, ...]
    denominator: str  # metric whose value divides the per-unit metrics
    ratio_label: str  # ``{stem}_per_{ratio_label}``
    key_col: str = "entity_key"
    name_col: str = "entity"
    score_col: str = "activity_score"
    combined_col: str = "combined_yoy_pct"
    class_col: str = "activity_class"
    fact_columns: tuple[str, ...] = field(default=FACT_COLUMNS_TEMPLATE)

    def metric(self, name: str) -> MetricSpec:
        return next(m for m in self.metrics if m.metric == name)

    def ratio_column(self, m: MetricSpec) -> str:
        return f"{m.value_stem}_per_{self.ratio_label}"

    def reference_filter(self) -> Column:
        return reduce(
            lambda a, b: a | b,
            [(F.col("metric") == m.metric) & (F.col("year") == m.year) for m in self.metrics],
        )

    def output_columns(self) -> list[str]:
        cols = [self.key_col, self.name_col]
        for m in self.metrics:
            cols += [m.year_column, m.value_column, m.yoy_column, m.five_year_column]
        est = [m for m in self.metrics if m.estimates]
        cols += [m.prior_year_estimate for m in est] + [m.five_year_estimate for m in est]
        cols += [self.ratio_column(m) for m in self.metrics if m.per_unit]
        return cols + [self.combined_col, self.class_col, self.score_col]


# Fixed values of the published energy snapshot: metric names, reference
# years, score weights 45/35/20 and the column stems of its 23-column mart.
ENERGY_MART = MartSpec(
    metrics=(
        MetricSpec("oil_production", "oil", 2025, 45, stem="oil_m3", estimates=True,
                   momentum=True, per_unit=True),
        MetricSpec("natural_gas_production", "gas", 2025, 35, stem="gas_m3", estimates=True,
                   momentum=True, per_unit=True),
        MetricSpec("well_count", "well_count", 2024, 20),
    ),
    denominator="well_count",
    ratio_label="reported_well",
    key_col="municipality_key",
    name_col="municipality",
    score_col="energy_activity_score",
)

# The activity snapshot of the driver tables, shaped the same way.
ACTIVITY_MART = MartSpec(
    metrics=(
        MetricSpec("billed", "billed", 2000, 45, estimates=True, momentum=True, per_unit=True),
        MetricSpec("returned_qty", "returned_qty", 2000, 35, estimates=True, momentum=True,
                   per_unit=True),
        MetricSpec("order_count", "order_count", 1999, 20),
    ),
    denominator="order_count",
    ratio_label="order",
)


def reference_rows(silver: DataFrame, spec: MartSpec) -> DataFrame:
    """Rows of each metric's reference year (filter first; pushed to the scan)."""
    return silver.filter(spec.reference_filter())


def build_dimension(rows: DataFrame, spec: MartSpec) -> DataFrame:
    """One row per key: the name from the highest-priority metric, then by name.

    Priority is the metric order of the spec (the published pipeline
    concatenates its sources in that order and keeps the first row per key).
    """
    priority = F.create_map(
        *[x for i, m in enumerate(spec.metrics) for x in (F.lit(m.metric), F.lit(i))]
    )[F.col("metric")]
    first = F.min(F.struct(priority.alias("p"), F.col(spec.name_col).alias("n")))
    return rows.groupBy(spec.key_col).agg(first["n"].alias(spec.name_col))


def build_fact(silver: DataFrame, spec: MartSpec) -> DataFrame:
    """Long fact: every silver row with the entity columns."""
    return silver.select(spec.key_col, spec.name_col, *spec.fact_columns)


def _metric_slice(rows: DataFrame, spec: MartSpec, m: MetricSpec) -> DataFrame:
    return rows.filter(F.col("metric") == m.metric).select(
        F.col(spec.key_col),
        F.col("year").alias(m.year_column),
        F.col("value").alias(m.value_column),
        F.col("yoy_change_pct").alias(m.yoy_column),
        F.col("five_year_change_pct").alias(m.five_year_column),
    )


def wide_by_join(rows: DataFrame, spec: MartSpec) -> DataFrame:
    """Dimension left-joined with one slice per metric."""
    wide = build_dimension(rows, spec)
    for m in spec.metrics:
        wide = wide.join(_metric_slice(rows, spec, m), on=spec.key_col, how="left")
    return wide


def wide_by_aggregate(rows: DataFrame, spec: MartSpec) -> DataFrame:
    """Single-shuffle pivot of the reference rows (see module notes)."""
    priority = F.create_map(
        *[x for i, m in enumerate(spec.metrics) for x in (F.lit(m.metric), F.lit(i))]
    )[F.col("metric")]
    aggs = [F.min(F.struct(priority.alias("p"), F.col(spec.name_col).alias("n")))["n"]
            .alias(spec.name_col)]
    for m in spec.metrics:
        picked = F.max(
            F.when(
                F.col("metric") == m.metric,
                F.struct(
                    F.col("year").alias("y"),
                    F.col("value").alias("v"),
                    F.col("yoy_change_pct").alias("r1"),
                    F.col("five_year_change_pct").alias("r5"),
                ),
            )
        )
        aggs.append(picked.alias(f"__{m.prefix}"))
    wide = rows.groupBy(spec.key_col).agg(*aggs)
    cols = [F.col(spec.key_col), F.col(spec.name_col)]
    for m in spec.metrics:
        s = f"__{m.prefix}"
        cols += [
            F.col(f"{s}.y").alias(m.year_column),
            F.col(f"{s}.v").alias(m.value_column),
            F.col(f"{s}.r1").alias(m.yoy_column),
            F.col(f"{s}.r5").alias(m.five_year_column),
        ]
    return wide.select(*cols)


def add_measures(wide: DataFrame, spec: MartSpec) -> DataFrame:
    """Fill missing values with 0 and derive estimates, ratios and momentum.

    A missing metric has value 0 but null rates, so its estimates are null.
    """
    wide = wide.fillna({m.value_column: 0.0 for m in spec.metrics})
    est = [m for m in spec.metrics if m.estimates]
    denom = spec.metric(spec.denominator).value_column
    extra = [prior_estimate(m.value_column, m.yoy_column).alias(m.prior_year_estimate) for m in est]
    extra += [prior_estimate(m.value_column, m.five_year_column).alias(m.five_year_estimate)
              for m in est]
    extra += [guarded_ratio(m.value_column, denom).alias(spec.ratio_column(m))
              for m in spec.metrics if m.per_unit]
    combined = row_mean(*[m.yoy_column for m in spec.metrics if m.momentum])
    wide = wide.select("*", *extra, combined.alias(spec.combined_col))
    return wide.withColumn(spec.class_col, momentum_class(spec.combined_col))


def add_score(wide: DataFrame, spec: MartSpec) -> DataFrame:
    """Weighted log min-max score, rounded half-even to 2 decimals."""
    logs = {m.metric: f"__log_{i}" for i, m in enumerate(spec.metrics)}
    logged = wide.select("*", *[log_activity(m.value_column).alias(logs[m.metric])
                                for m in spec.metrics])
    # All extrema in ONE aggregation: an uncorrelated subquery of the plan, so
    # nothing runs before the mart does and nothing is joined back.
    extrema = logged.agg(F.struct(
        *[F.min(c).alias(f"lo_{c}") for c in logs.values()],
        *[F.max(c).alias(f"hi_{c}") for c in logs.values()],
    ).alias("extrema")).scalar()
    total = None
    for m in spec.metrics:
        c = logs[m.metric]
        lo, hi = extrema[f"lo_{c}"], extrema[f"hi_{c}"]
        term = F.lit(m.weight) * min_max_scaled(c, lo, hi)
        total = term if total is None else total + term
    return logged.select(*wide.columns, round_half_even(total, 2).alias(spec.score_col))


def build_mart(
    silver: DataFrame, spec: MartSpec, strategy: str = "join", stage: bool = True
) -> DataFrame:
    """The wide scored mart, one row per entity (C4); unsorted (sort at sinks).

    With ``stage`` the unscored wide rows are written once (entity-sized, far
    smaller than silver) so that the extrema aggregate and the scoring both
    scan them instead of running the dimension and metric joins twice.
    """
    rows = reference_rows(silver, spec)
    if strategy == "join":
        wide = wide_by_join(rows, spec)
    elif strategy == "aggregate":
        wide = wide_by_aggregate(rows, spec)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    wide = add_measures(wide, spec)
    if stage:
        from snapmart.sources.sinks import stage_table

        wide = stage_table(wide, "mart_wide")
    return add_score(wide, spec).select(*spec.output_columns())


def dimension_order(spec: MartSpec) -> list[Column]:
    """Dimension by name, then key."""
    return [F.col(spec.name_col).asc_nulls_last(), F.col(spec.key_col).asc_nulls_last()]


def fact_order(spec: MartSpec) -> list[Column]:
    """Fact by metric, value descending, then key and year (O3)."""
    return [F.col("metric").asc_nulls_last(), F.col("value").desc_nulls_last(),
            F.col(spec.key_col).asc_nulls_last(), F.col("year").asc_nulls_last()]


def silver_order(spec: MartSpec) -> list[Column]:
    """Silver by name and year, then metric (O1)."""
    return [F.col(spec.name_col).asc_nulls_last(), F.col("year").asc_nulls_last(), F.col("metric").asc_nulls_last()]


def mart_order(spec: MartSpec) -> list[Column]:
    """Published mart order: score descending, then name, then key (O2)."""
    return [
        F.col(spec.score_col).desc_nulls_last(),
        F.col(spec.name_col).asc_nulls_last(),
        F.col(spec.key_col).asc_nulls_last(),
    ]
