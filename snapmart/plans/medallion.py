"""Composed medallion runs over the activity snapshot.

``bronze -> quality report (+ gate) -> silver -> gold`` with the same steps the
published snapshot pipeline takes, each a lazy DataFrame transformation; the
only actions are the gate (a datasets x rules report) and the writes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.keys import lake_key
from snapmart.operators import quality as q
from snapmart.operators.marts import ACTIVITY_MART, MartSpec, build_dimension, build_fact, build_mart
from snapmart.operators.marts import reference_rows
from snapmart.operators.standardize import lake_silver, standardize
from snapmart.plans.activity import ACTIVITY_SOURCES, SNAPSHOT_COLUMNS, activity_long
from snapmart.sources.files import stamp_lineage
from snapmart.sources.lake import CODEC, VersionedTable
from snapmart.sources.sinks import stage_bucketed, stage_table, write_csv

ENTITY_KEY = ("entity", "year", "metric")


def activity_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the activity snapshot: lineage + fingerprint."""
    raw = activity_long(spark, sf_dir).withColumn("source_file", F.col("dataset"))
    return stamp_lineage(raw, SNAPSHOT_COLUMNS)


# Order years of the driver tables start in the 1990s; the published snapshot's
# own range (2000-2100) would reject them.
ACTIVITY_YEAR_RANGE = (1990, 2100)


# Growth rates are nullable by contract (null without a prior year); every
# other snapshot column is required.
ACTIVITY_REQUIRED = [c for c in SNAPSHOT_COLUMNS
                     if c not in ("yoy_change_pct", "five_year_change_pct")]


def activity_rules() -> list[q.Rule]:
    rules = q.snapshot_rules(ACTIVITY_REQUIRED, key=ENTITY_KEY)
    return [
        q.in_range("year", *ACTIVITY_YEAR_RANGE) if r.name == "year_in_expected_range" else r
        for r in rules
    ]


def activity_quality(bronze: DataFrame) -> DataFrame:
    """The six snapshot checks per dataset in one pass (Q1-Q7)."""
    return q.quality_report(bronze, activity_rules(), [source.dataset for source in ACTIVITY_SOURCES])


def activity_silver(bronze: DataFrame) -> DataFrame:
    return standardize(bronze, name_col="entity", key_col="entity_key")


def stage_silver(silver: DataFrame, path: str | None = None, key: str | None = None) -> DataFrame:
    """Write silver partitioned by metric, year-sorted inside each file: the
    mart's reference-year filter prunes folders and skips row groups, and a
    per-metric extract reads one folder. With ``key`` it is bucketed by it too,
    so that the dimension and the mart's joins (C3, C4) exchange nothing."""
    if key:
        return stage_bucketed(silver, "silver", key, path=path, partition_by=["metric"], sort_within=["year"])
    return stage_table(silver, "silver", path, partition_by=["metric"], sort_within=["year"])


@dataclass
class GoldTables:
    dimension: DataFrame
    fact: DataFrame
    mart: DataFrame


def build_gold(silver: DataFrame, spec: MartSpec = ACTIVITY_MART, strategy: str = "join") -> GoldTables:
    rows = reference_rows(silver, spec)
    return GoldTables(
        dimension=build_dimension(rows, spec),
        fact=build_fact(silver, spec),
        mart=build_mart(silver, spec, strategy=strategy),
    )


def gated_run(
    spark: SparkSession,
    sf_dir: str,
    report_path: str | None = None,
    strategy: str = "join",
    silver_path: str | None = None,
    bronze_path: str | None = None,
) -> GoldTables:
    """Bronze, report, gate, silver, gold.

    The report is written (when a path is given) *before* the gate raises, so
    a failed run leaves the evidence it points to.
    """
    # bronze is a written layer: the report and silver both scan it, so the
    # source joins run once
    bronze = stage_table(activity_bronze(spark, sf_dir), "bronze", bronze_path)
    report = activity_quality(bronze)
    if report_path:
        write_csv(report, report_path)
    q.enforce_gate(report, report_path or "the data-quality report")
    silver = stage_silver(activity_silver(bronze), silver_path, key=ACTIVITY_MART.key_col)
    return build_gold(silver, strategy=strategy)


def lake_run(spark: SparkSession, sf_dir: str, root: str) -> dict[str, object]:
    """The lake path (C8): bronze upsert keyed by the lake key, silver with
    filter-then-dedupe, silver upsert, Parquet export; returns row counts.

    Row counts are observed while the versions are written (A10), so the
    source plan is not run again to count it.
    """
    bronze = stage_table(activity_bronze(spark, sf_dir).withColumn("lake_key", lake_key("entity")), "lake-bronze", f"{root}/landed",
                         compression=CODEC)
    keys = ["lake_key", "year", "metric"]
    bronze_table = VersionedTable(spark, f"{root}/bronze", partition_by=["metric"])
    # two loads: an earlier snapshot with half the years and other values, then
    # the full one, which changes those rows and adds the rest
    earlier = bronze.filter("year % 2 = 0").withColumn("value", F.col("value") + 1)
    bronze_table.upsert(earlier, keys)
    bronze_table.upsert(bronze, keys)
    bronze_rows = bronze_table.last_rows_written
    stored = bronze_table.read()
    silver = lake_silver(stored, keys)
    silver_table = VersionedTable(spark, f"{root}/silver", partition_by=["metric"])
    silver_table.upsert(silver, keys)
    silver_rows = silver_table.last_rows_written
    export = f"{root}/silver_export"
    silver_table.read().write.mode("overwrite").parquet(export, compression=CODEC)
    return {
        "bronze": bronze_table,
        "silver": silver_table,
        "export": export,
        "bronze_rows": bronze_rows,
        "silver_rows": silver_rows,
    }


# Table names of the published energy snapshot's gold layer.
ENERGY_GOLD_NAMES = ("dim_municipality", "fct_energy_activity", "mart_municipality_energy_summary")


def run_snapshot(
    spark: SparkSession,
    sources: list,
    root: str,
    spec: MartSpec | None = None,
    rules: list[q.Rule] | None = None,
    names: tuple[str, str, str] = ENERGY_GOLD_NAMES,
) -> DataFrame:
    """The published snapshot run over CSV files.

    ``sources`` are :class:`~snapmart.sources.files.SnapshotSource` entries
    (one per dataset with its expected metric). Bronze and silver are written
    under ``root``; the report is written before the gate can stop the run;
    the gold tables and every serving output follow. Returns the run manifest.
    """
    from snapmart.operators.marts import ENERGY_MART
    from snapmart.plans.outputs import write_outputs
    from snapmart.sources.files import REQUIRED_COLUMNS, stage_bronze

    spec = spec or ENERGY_MART
    root = root.rstrip("/")
    bronze = stage_bronze(spark, sources, f"{root}/lakehouse/bronze")
    # three readers: the CSV, the gate and the outputs
    report = stage_table(q.quality_report(
        bronze, rules or q.snapshot_rules(REQUIRED_COLUMNS), list(dict.fromkeys(source.dataset for source in sources))), "report")
    report_path = f"{root}/results/data_quality_report"
    write_csv(report, report_path)
    q.enforce_gate(report, report_path)
    silver = stage_bucketed(standardize(bronze, name_col=spec.name_col, key_col=spec.key_col),
                            "silver", spec.key_col, path=f"{root}/lakehouse/silver", partition_by=["dataset"],
                            sort_within=[spec.name_col, "year"])
    gold = build_gold(silver, spec)
    return write_outputs(spark, gold, report, f"{root}/warehouse", spec, names)

