"""Plan regression tests: the physical properties the scale design relies on."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module
from snapmart.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    df.collect()  # final adaptive plan of the DataFrame's own execution
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def plans(spark):
    q = entry_module.queries()
    names = ["dedup_keep_last", "topk_by_metric", "mart_entity_summary", "entity_rankings",
             "metric_extract", "activity_long", "dq_report"]
    found = {n: _plan(q[n](spark, SF_SMALL)) for n in names}
    staged = catalog._fact(spark, SF_SMALL, staged=True)
    return {**found, "staged_extract": _plan(staged.filter("metric = 'billed'"))}


def test_dedupe_combines_before_the_shuffle(plans):
    p = plans["dedup_keep_last"]
    assert "SortAggregate" not in p
    assert p.index("Exchange hashpartitioning") < p.rindex("WindowGroupLimit")  # the partial one is below


def test_top_k_limits_before_the_shuffle(plans):
    assert plans["topk_by_metric"].count("WindowGroupLimit") >= 2


def test_no_cross_products(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_rank_uses_no_global_window(plans):
    p = plans["entity_rankings"]
    # the only windows are those over the (range, group) rows
    for line in p.splitlines():
        if "Window [" in line:
            assert "windowspecdefinition(__g0" in line


def test_rank_never_deals_rows_out_by_value(spark):
    from pyspark.sql import functions as F

    from snapmart.operators.ranking import dense_rank_by

    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 50).alias("v"), "id")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, -1)
    try:
        p = _plan(dense_rank_by(df, ["g"], "v", num_partitions=4))
    finally:
        spark.conf.set(conf, before)
    assert "hashpartitioning" in p
    assert not re.search(r"hashpartitioning\([^)]*\bv#", p)


def test_mart_joins_exchange_nothing_above_the_bucketed_layer(spark):
    from snapmart.operators.marts import ACTIVITY_MART, reference_rows, wide_by_join

    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, -1)
    try:
        silver = catalog._silver(spark, SF_SMALL, key=ACTIVITY_MART.key_col)
        p = _plan(wide_by_join(reference_rows(silver, ACTIVITY_MART), ACTIVITY_MART))
    finally:
        spark.conf.set(conf, before)
    assert p.count("SortMergeJoin") == 3
    assert "Exchange" not in p
    assert "Bucketed: true" in p
    assert re.search(r"PushedFilters: \[.*EqualTo\(year,", p)


def test_staged_silver_is_pruned(plans):
    p = plans["staged_extract"]
    assert re.search(r"PartitionFilters: \[.*metric.*= billed", p)
    assert "ReadSchema: struct<" in p


def test_scans_push_filters_and_prune_columns(plans):
    p = plans["activity_long"]
    assert re.search(r"PushedFilters: \[.*EqualTo\(l_returnflag,R\)", p)
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>",
                     p)


@pytest.mark.parametrize("name", ["silver_activity", "stg_activity", "fact_activity", "metric_summary", "metric_extract"])
def test_single_reader_queries_build_without_writing(spark, name):
    from snapmart import session

    before = len(session._SCRATCH)
    entry_module.queries()[name](spark, SF_SMALL)
    assert len(session._SCRATCH) == before


def test_no_python_in_any_plan(plans):
    for name, p in plans.items():
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEval" not in p, name
