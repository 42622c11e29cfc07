"""Serving outputs of a gated run and its manifest.

Layout under ``root``::

    gold/parquet/<table>/         K2   dimension, fact, mart
    gold/csv/<table>/             K1   sorted at the sink (O2-O4)
    extracts/fact_by_metric/metric=<m>/   K7   one partitioned write
    extracts/mart_entity_summary/, extracts/data_quality_report/
    results/data_quality_report/  K8   (the report in two places)
    results/top_by_metric/metric=<m>/     top-10 lists (O5)
    results/summary_metrics/      K9   one-row JSON document
    results/run_manifest/  K10 one-row JSON document

Gold tables are written once as Parquet; every other output reads those files,
so the upstream plan never runs twice. The manifest is made from what was written: it
lists the folders, counts the gold tables and reads the CSV outputs back for a count and a digest each.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.marts import ACTIVITY_MART, MartSpec, dimension_order, fact_order, mart_order
from snapmart.plans import serving
from snapmart.plans.medallion import GoldTables
from snapmart.sources.files import CSV_OPTIONS, list_files
from snapmart.sources.lake import literal_path
from snapmart.sources.sinks import (
    stage_table,
    write_csv,
    write_json_document,
    write_metric_extracts,
)

GOLD_NAMES = ("dim_entity", "fct_activity", "mart_entity_summary")


def write_outputs(
    spark: SparkSession,
    gold: GoldTables,
    report: DataFrame,
    root: str,
    spec: MartSpec = ACTIVITY_MART,
    names: tuple[str, str, str] = GOLD_NAMES,
) -> DataFrame:
    """Write every serving output of a run and return its one-row manifest.

    ``names`` are the (dimension, fact, mart) table names."""
    root = root.rstrip("/")
    staged = {
        name: stage_table(df, name, f"{root}/gold/parquet/{name}")
        for name, df in zip(names, (gold.dimension, gold.fact, gold.mart))
    }
    dim_name, fact_name, mart_name = names
    dim, fact, mart = (staged[n] for n in names)
    write_csv(dim, f"{root}/gold/csv/{dim_name}", dimension_order(spec))
    write_csv(fact, f"{root}/gold/csv/{fact_name}", fact_order(spec))
    write_csv(mart, f"{root}/gold/csv/{mart_name}", mart_order(spec))

    report = stage_table(report, "report", f"{root}/staged/data_quality_report")
    write_csv(report, f"{root}/results/data_quality_report")
    write_csv(report, f"{root}/extracts/data_quality_report")
    write_csv(mart, f"{root}/extracts/{mart_name}", mart_order(spec))
    write_metric_extracts(fact, f"{root}/extracts/fact_by_metric")
    tops = serving.top_by_metric(mart, spec, 10)
    write_csv(tops, f"{root}/results/top_by_metric", partition_by=["metric"])
    write_json_document(serving.snapshot_metrics(fact, mart, report, spec),
                        f"{root}/results/summary_metrics")

    manifest = run_manifest(spark, root, staged, report, spec)
    write_json_document(manifest, f"{root}/results/run_manifest")
    # as written: the outputs are read back and digested once
    return spark.read.schema(manifest.schema).json(literal_path(f"{root}/results/run_manifest"))


#: CSV outputs that the manifest reads back: the report in two places, the top lists, the fact's extracts.
DIGESTED = ("report", "report_copy", "top_lists", "fact_extracts")


def _folder_names(spark: SparkSession, folder: str, column: str) -> DataFrame:
    """One row: the sorted names of the outputs that have files in ``folder``."""
    plain = re.sub("^[a-z0-9]+:/+", "/", folder)
    name = F.regexp_extract("path", f"{re.escape(plain)}/([^/]+)/", 1)
    return list_files(spark, literal_path(folder), "part-*").agg(F.array_sort(F.collect_set(name)).alias(column))


def _digest(spark: SparkSession, output: str, path: str, columns: list[str]) -> DataFrame:
    """(output, rows, digest) of a CSV output as it stands: the digest adds up 48 bits of each line's MD5, in any order."""
    lines = spark.read.options(**CSV_OPTIONS).option("inferSchema", False).csv(literal_path(path))
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    part = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("decimal(38,0)")
    return lines.agg(
        F.lit(output).alias("output"), F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(part).cast("string"), F.lit("0")).alias("digest"))


def run_manifest(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame],
    report: DataFrame,
    spec: MartSpec = ACTIVITY_MART,
) -> DataFrame:
    """One row: the outputs found below ``root``, rows per gold table (one union aggregation over the
    written tables), rows and digest of each output of DIGESTED, and the check totals (K8, K10, A9)."""
    counts = serving.table_row_counts(spark, tables).agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("table_name", "row_count")))
        ).alias("row_counts")
    )
    checks = report.agg(
        F.count(F.lit(1)).alias("quality_checks"),
        F.count_if(F.col("status") == "FAIL").alias("quality_failures"),
    )
    listings = {"gold_tables": "gold/parquet", "extract_tables": "extracts", "result_files": "results"}
    report_columns, top = ["dataset", "check_name", "status", "failed_rows", "severity"], ["metric", "position", spec.key_col]
    places = {
        "report": ("results/data_quality_report", report_columns),
        "report_copy": ("extracts/data_quality_report", report_columns),
        "top_lists": ("results/top_by_metric", top),
        "fact_extracts": ("extracts/fact_by_metric", ["metric", "year", spec.key_col]),
    }
    digests = reduce(DataFrame.unionByName, [_digest(spark, name, f"{root}/{path}", columns) for name, (path, columns) in places.items()])
    digests = digests.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("output", F.struct("rows", "digest").alias("found"))))).alias("digests"))
    listed = [_folder_names(spark, f"{root}/{path}", name) for name, path in listings.items()]
    return serving.one_row(*listed, counts, digests, checks).select(
        *listings, "row_counts", "digests", "quality_checks", "quality_failures")
