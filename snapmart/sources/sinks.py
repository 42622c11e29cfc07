"""Sinks: CSV / Parquet / JSON writers, per-metric extracts, views.

Writers never sort unless asked (a total order is a full shuffle); per-metric
extracts are one ``partitionBy`` write rather than one filtered pass each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from snapmart.session import scratch_path, scratch_table
from snapmart.sources.files import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, order_by: Sequence[Column] = (), partition_by: Sequence[str] = ()) -> None:
    """Header CSV, full overwrite (K1, K8); with ``partition_by`` a folder for each value."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).partitionBy(*partition_by).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, full overwrite (K2, K3)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_metric_extracts(fact: DataFrame, path: str, metric_col: str = "metric") -> None:
    """All per-metric extracts in one pass: ``{path}/metric=<m>/`` (K7)."""
    write_csv(fact, path, partition_by=[metric_col])


def write_json_document(df: DataFrame, path: str) -> None:
    """A small (one-row) document as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def publish_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Publish tables for SQL as temp views (K6, K11 'view').

    Re-publishing replaces the previous definitions, like the drop-and-rebuild
    of the published serving database.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def materialize_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Materialise as a catalog table (K11 'table'); overwrite."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def stage_table(
    df: DataFrame,
    label: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    compression: str | None = None,
) -> DataFrame:
    """Write ``df`` once as Parquet (default: a fresh folder under the shared
    checkpoint location) and return a scan of it with the same schema.

    Used at layer boundaries (bronze/silver/gold) that several downstream
    branches read: the upstream plan runs once instead of once per branch, the
    lineage is cut (an executor loss re-reads files, it does not recompute the
    source joins), and readers get Parquet column pruning and filter pushdown.
    ``partition_by`` turns filters on those columns into folder pruning;
    ``sort_within`` orders rows inside each file so row-group statistics can
    skip on that column too (the partitioned writer sorts anyway, so this adds
    no shuffle). ``compression`` is the files' codec (default: the session's).
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, label)
    out = df
    if partition_by or sort_within:
        out = df.sortWithinPartitions(*partition_by, *sort_within)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target, compression=compression)
    return spark.read.schema(df.schema).parquet(target).select(*df.columns)


def stage_bucketed(
    df: DataFrame,
    label: str,
    key: str,
    buckets: int | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
) -> DataFrame:
    """:func:`stage_table` for a layer whose readers group and join on ``key``.

    The files are dealt into ``buckets`` by the hash of ``key`` (default: the session's
    ``spark.sql.shuffle.partitions``, which tracks the data's size), so aggregations
    and joins on ``key`` over this layer exchange nothing: the rows travel once, at
    this write, however many readers follow. Partition folders and the order by
    ``sort_within`` inside a file keep their pruning. The deal is a rebalance: Spark
    splits the write of a bucket that a hot key makes large (it then has several
    files) and merges the writes of small ones.

    Spark knows buckets through the catalog only, so the folder is registered as an
    external table of a fresh name, dropped with the scratch folder or at the driver's
    end; dropping it leaves the files of a caller's ``path``.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = path or scratch_path(spark, label)
    name = scratch_table(spark, label, target)
    writer = df.hint("rebalance", count, key).write.mode("overwrite").format("parquet").option("path", target)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(count, key).sortBy(*sort_within, key).saveAsTable(name)
    return spark.table(name).select(*df.columns)
