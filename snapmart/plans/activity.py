"""The activity snapshot: a long (entity, year, metric) table derived from the
driver's order tables, shaped like a published statistical snapshot.

| dataset      | metric       | value                       | rows from                 | unit     |
|--------------|--------------|-----------------------------|---------------------------|----------|
| billed       | billed       | sum(o_totalprice)           | orders, status F          | currency |
| returned     | returned_qty | sum(l_quantity)             | lineitem, flag R, ⋈ orders| items    |
| open_orders  | order_count  | count(*)                    | orders, status O          | count    |

Entities are customer names, years are order years. ``yoy_change_pct`` and
``five_year_change_pct`` compare with the same entity and metric one and five
years earlier (null without such a year), rounded half-even to 2 decimals as
published rates are. Money and quantities are summed exactly in DECIMAL.

Plan shape (all shuffles are on pre-aggregated rows except the order join):

1. ``lineitem`` (flag R) -> partial+final sum by ``l_orderkey``;
2. ``orders`` left-join that on the order key (the aggregate side is already
   hash-partitioned on it, so only ``orders`` moves);
3. one conditional aggregation by ``(o_custkey, year)`` yields all three
   metrics from the single ``orders`` scan (map-side combine absorbs hot keys);
4. join ``customer`` for the name (AQE broadcasts it when it is small);
5. regroup by (name, year), map-side combined, then the year-offset windows
   per entity run over those aggregated rows (at most one per year).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.functions.numeric import percent_change, round_half_even

# Column contract of the snapshot (the published 12 plus the dataset name).
SNAPSHOT_COLUMNS = [
    "entity",
    "year",
    "metric",
    "value",
    "unit",
    "yoy_change_pct",
    "five_year_change_pct",
    "source_name",
    "source_url",
    "source_last_updated",
    "licence",
    "snapshot_retrieved_at",
]
ACTIVITY_COLUMNS = ["dataset", *SNAPSHOT_COLUMNS]

ACTIVITY_LICENCE = "CC-BY-4.0"
ACTIVITY_RETRIEVED_AT = "2026-07-24"
MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class ActivitySource:
    dataset: str
    metric: str
    unit: str
    source_name: str
    source_url: str


ACTIVITY_SOURCES = (
    ActivitySource("billed", "billed", "currency", "orders", "https://data.example.org/orders/billed"),
    ActivitySource(
        "returned", "returned_qty", "items", "lineitem", "https://data.example.org/lineitem/returned"
    ),
    ActivitySource(
        "open_orders", "order_count", "count", "orders", "https://data.example.org/orders/open"
    ),
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def activity_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (entity, year) with the three metric values and last dates."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    lineitem = read_table(spark, sf_dir, "lineitem")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")

    returned = (
        lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("l_quantity").cast(MONEY)).alias("returned_qty"))
    )
    is_billed = F.col("o_orderstatus") == "F"
    is_open = F.col("o_orderstatus") == "O"
    has_return = F.col("returned_qty").isNotNull()
    per_customer = (
        orders.join(returned, orders.o_orderkey == returned.l_orderkey, "left")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(
            F.sum(F.when(is_billed, F.col("o_totalprice").cast(MONEY))).alias("billed"),
            F.max(F.when(is_billed, F.col("o_orderdate"))).alias("billed_last"),
            F.sum(F.col("returned_qty")).alias("returned_qty"),
            F.max(F.when(has_return, F.col("o_orderdate"))).alias("returned_last"),
            F.count_if(is_open).alias("order_count"),
            F.max(F.when(is_open, F.col("o_orderdate"))).alias("open_last"),
        )
    )
    named = per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
    # Entities are names; regroup in case several customer keys share a name.
    # A plain groupBy combines map-side first, so even a name shared by a third
    # of all customers reaches the shuffle as at most one row per year per task.
    return (
        named.groupBy(F.col("c_name").alias("entity"), "year")
        .agg(
            F.sum("billed").alias("billed"),
            F.max("billed_last").alias("billed_last"),
            F.sum("returned_qty").alias("returned_qty"),
            F.max("returned_last").alias("returned_last"),
            F.sum("order_count").alias("order_count"),
            F.max("open_last").alias("open_last"),
        )
    )


def _metric_struct(src: ActivitySource, value, last, prior1, prior5):
    return F.struct(
        F.lit(src.dataset).alias("dataset"),
        F.lit(src.metric).alias("metric"),
        value.cast("double").alias("value"),
        F.lit(src.unit).alias("unit"),
        round_half_even(percent_change(value.cast("double"), prior1.cast("double"))).alias(
            "yoy_change_pct"
        ),
        round_half_even(percent_change(value.cast("double"), prior5.cast("double"))).alias(
            "five_year_change_pct"
        ),
        F.lit(src.source_name).alias("source_name"),
        F.lit(src.source_url).alias("source_url"),
        F.date_format(last, "yyyy-MM-dd").alias("source_last_updated"),
    )


def activity_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13-column activity snapshot (``ACTIVITY_COLUMNS``)."""
    wide = activity_wide(spark, sf_dir).withColumn(
        "order_count", F.when(F.col("order_count") > 0, F.col("order_count"))
    )
    by_entity = Window.partitionBy("entity").orderBy("year")
    one_back = by_entity.rangeBetween(-1, -1)
    five_back = by_entity.rangeBetween(-5, -5)
    last_cols = {"billed": "billed_last", "returned_qty": "returned_last", "order_count": "open_last"}
    priors = []
    for src in ACTIVITY_SOURCES:
        priors.append(F.first(src.metric).over(one_back).alias(f"{src.metric}__p1"))
        priors.append(F.first(src.metric).over(five_back).alias(f"{src.metric}__p5"))
    wide = wide.select("*", *priors)
    structs = [
        _metric_struct(
            src,
            F.col(src.metric),
            F.col(last_cols[src.metric]),
            F.col(f"{src.metric}__p1"),
            F.col(f"{src.metric}__p5"),
        )
        for src in ACTIVITY_SOURCES
    ]
    rows = wide.select("entity", "year", F.explode(F.array(*structs)).alias("m"))
    return rows.filter(F.col("m.value").isNotNull()).select(
        "m.dataset",
        "entity",
        F.col("year").cast("int").alias("year"),
        "m.metric",
        "m.value",
        "m.unit",
        "m.yoy_change_pct",
        "m.five_year_change_pct",
        "m.source_name",
        "m.source_url",
        "m.source_last_updated",
        F.lit(ACTIVITY_LICENCE).alias("licence"),
        F.lit(ACTIVITY_RETRIEVED_AT).alias("snapshot_retrieved_at"),
    )
