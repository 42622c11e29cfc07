"""Data-quality rules, the one-pass report and the blocking gate (Q1-Q10).

All row-local rules of all datasets are evaluated in **one** aggregation. If a
uniqueness rule is present, that aggregation runs per (dataset, key) first, so
the duplicate count and every row rule share a single scan and a single
(map-side combined) shuffle; the published pipeline made six passes per
dataset. The report is tiny (datasets x rules) and is the only thing the gate
brings to the driver.

Null handling differs per rule on purpose (it matches the published checks):
``non_negative`` and ``not_blank`` pass nulls, ``in_range`` and
``starts_with`` fail them, ``accepted_values`` passes them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.util import as_col

PASS, FAIL = "PASS", "FAIL"
ERROR = "ERROR"
REPORT_COLUMNS = ["dataset", "check_name", "status", "failed_rows", "severity"]
# The characters with Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_whitespace(value: Column | str) -> Column:
    """Trim Unicode white space on both ends, in one pass over each end."""
    return F.trim(as_col(value), F.lit(WHITE_SPACE))


@dataclass(frozen=True)
class Rule:
    """A named check. ``failed`` flags a bad row; ``unique_keys`` marks the
    duplicate rule (rows beyond the first per key, nulls grouping together)."""

    name: str
    failed: Column | None = None
    unique_keys: tuple[str, ...] = ()
    severity: str = ERROR


def not_null(columns: Sequence[str], name: str = "required_fields_not_null") -> Rule:
    """Any listed column null."""
    flags = [F.col(c).isNull() for c in columns]
    expr = flags[0]
    for f in flags[1:]:
        expr = expr | f
    return Rule(name, failed=expr)


def unique(keys: Sequence[str], name: str = "municipality_year_unique") -> Rule:
    """Rows beyond the first per key."""
    return Rule(name, unique_keys=tuple(keys))


def non_negative(column: str, name: str = "value_non_negative") -> Rule:
    """Numeric value below 0; null or unparsable passes."""
    return Rule(name, failed=F.coalesce(F.col(column).try_cast("double") < 0, F.lit(False)))


def in_range(column: str, low: float, high: float, name: str = "year_in_expected_range") -> Rule:
    """Outside ``[low, high]``; null or unparsable fails."""
    inside = F.col(column).try_cast("double").between(low, high)
    return Rule(name, failed=~F.coalesce(inside, F.lit(False)))


def starts_with(column: str, prefix: str, name: str = "source_url_is_https") -> Rule:
    """Text not starting with ``prefix``; null fails."""
    ok = F.col(column).cast("string").startswith(prefix)
    return Rule(name, failed=~F.coalesce(ok, F.lit(False)))


def not_blank(column: str, name: str = "licence_present") -> Rule:
    """Empty after trimming white space; null passes."""
    return Rule(name, failed=F.coalesce(~F.col(column).rlike(r"[^\p{IsWhite_Space}]"), F.lit(False)))


def accepted_values(column: str, values: Sequence[str], name: str | None = None) -> Rule:
    """Value outside the accepted set; null passes (Q10)."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return Rule(name or f"accepted_values_{column}", failed=bad)


def column_not_null(column: str, name: str | None = None) -> Rule:
    """One column null (Q9)."""
    return Rule(name or f"not_null_{column}", failed=F.col(column).isNull())


# Fixed values of the published snapshot checks: https URLs, years 2000-2100.
SNAPSHOT_YEAR_RANGE = (2000, 2100)
SNAPSHOT_URL_PREFIX = "https://"


def snapshot_rules(
    required: Sequence[str], key: Sequence[str] = ("municipality", "year", "metric")
) -> list[Rule]:
    """The six published checks for a snapshot table, in published order."""
    return [
        not_null(required),
        unique(key),
        non_negative("value"),
        in_range("year", *SNAPSHOT_YEAR_RANGE),
        starts_with("source_url", SNAPSHOT_URL_PREFIX),
        not_blank("licence"),
    ]


def _one_pass_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failures per dataset for every rule, in one scan."""
    uniq = [r for r in rules if r.unique_keys]
    if len(uniq) > 1:
        raise ValueError("at most one uniqueness rule per report")
    flags = {f"f{i}": r.failed for i, r in enumerate(rules) if r.failed is not None}
    if not uniq:
        return df.groupBy("dataset").agg(
            *[F.count_if(expr).alias(k) for k, expr in flags.items()]
        )
    keys = list(uniq[0].unique_keys)
    per_key = df.groupBy("dataset", *keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(expr).alias(k) for k, expr in flags.items()],
    )
    dup_index = rules.index(uniq[0])
    return per_key.groupBy("dataset").agg(
        F.sum(F.col("__n") - 1).alias(f"f{dup_index}"),
        *[F.sum(k).alias(k) for k in flags],
    )


def quality_report(
    datasets: Mapping[str, DataFrame] | DataFrame,
    rules: Sequence[Rule] | Mapping[str, Sequence[Rule]],
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (dataset, rule): status PASS iff 0 failures (Q7).

    ``datasets`` is either a mapping name -> DataFrame, or one long DataFrame
    with a ``dataset`` column. ``rules`` is one rule list for all datasets or
    a mapping per dataset. Datasets without rows still get their rows; of one long
    frame with one rule list, those that ``names`` lists.
    """
    if isinstance(datasets, DataFrame):
        spark = datasets.sparkSession
        if not isinstance(rules, Mapping):
            return _report_for(spark, datasets, list(names) if names else None, list(rules))
        parts = [
            _report_for(spark, datasets.filter(F.col("dataset") == name), [name], list(r))
            for name, r in rules.items()
        ]
    else:
        spark = next(iter(datasets.values())).sparkSession
        parts = []
        for name, df in datasets.items():
            r = rules[name] if isinstance(rules, Mapping) else rules
            parts.append(
                _report_for(spark, df.withColumn("dataset", F.lit(name)), [name], list(r))
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _report_for(
    spark: SparkSession, df: DataFrame, names: list[str] | None, rules: list[Rule]
) -> DataFrame:
    counts = _one_pass_counts(df, rules)
    if names is not None:
        # keep empty datasets: add a zero row per dataset name and sum (no join)
        zero = spark.createDataFrame([(n,) for n in names], "dataset string").select(
            "dataset", *[F.lit(0).cast("long").alias(c) for c in counts.columns if c != "dataset"])
        counts = counts.select("dataset", *[F.col(c).cast("long") for c in zero.columns[1:]])
        counts = counts.unionByName(zero).groupBy("dataset").agg(
            *[F.sum(c).alias(c) for c in zero.columns[1:]])
    entries = [
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(r.name).alias("check_name"),
            F.coalesce(F.col(f"f{i}"), F.lit(0)).cast("long").alias("failed_rows"),
            F.lit(r.severity).alias("severity"),
        )
        for i, r in enumerate(rules)
    ]
    long = counts.select("dataset", F.explode(F.array(*entries)).alias("c"))
    return long.select(
        "dataset",
        F.col("c.check_name").alias("check_name"),
        F.when(F.col("c.failed_rows") == 0, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
        F.col("c.failed_rows").alias("failed_rows"),
        F.col("c.severity").alias("severity"),
    )


def blocking_failures(report: DataFrame) -> DataFrame:
    """Rows that block the pipeline: FAIL with ERROR severity."""
    return report.filter("status = 'FAIL' AND severity = 'ERROR'")


class QualityGateError(ValueError):
    pass


def enforce_gate(report: DataFrame, report_location: str = "the data-quality report") -> None:
    """Raise when any blocking check failed (Q8). Collects only failing report rows."""
    failing = blocking_failures(report).collect()
    if failing:
        detail = ", ".join(f"{r.dataset}.{r.check_name}={r.failed_rows}" for r in failing)
        raise QualityGateError(
            f"Blocking data-quality checks failed; review {report_location} ({detail})"
        )


def gate_status(report: DataFrame) -> DataFrame:
    """One-row summary: checks, failures, blocking failures (A5)."""
    return report.agg(
        F.count(F.lit(1)).alias("quality_checks"),
        F.count_if(F.col("status") == FAIL).alias("quality_failures"),
        F.count_if((F.col("status") == FAIL) & (F.col("severity") == ERROR)).alias(
            "blocking_failures"
        ),
    )
