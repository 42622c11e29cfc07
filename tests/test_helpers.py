"""Small sinks and aggregates not covered by a registered query."""

from __future__ import annotations

import pytest

from snapmart.operators.aggregates import floor_max, global_extrema, rows_per_group
from snapmart.sources import files
from snapmart.sources.sinks import materialize_table, publish_views


def test_views_and_tables(spark, workdir):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "name string, score double")
    assert publish_views(spark, {"t_scores": df}) == ["t_scores"]
    top = spark.sql("SELECT name FROM t_scores ORDER BY score DESC LIMIT 1").first()
    assert top.name == "a"
    materialize_table(df, "t_scores_tbl", path=f"{workdir}/tbl")
    assert spark.table("t_scores_tbl").count() == 2
    materialize_table(df.limit(1), "t_scores_tbl", path=f"{workdir}/tbl2")
    assert spark.table("t_scores_tbl").count() == 1  # replaced, like drop-and-rebuild


def test_rows_per_group_and_extrema(spark):
    df = spark.createDataFrame([("oil", 1.0), ("oil", 5.0), ("gas", 0.5)], "m string, v double")
    assert {r.m: r.rows for r in rows_per_group(df, "m").collect()} == {"oil": 2, "gas": 1}
    ext = global_extrema(df, ["v"]).first()
    assert (ext["v__min"], ext["v__max"]) == (0.5, 5.0)
    assert floor_max(df, "v").first().scale_max == 5.0
    assert floor_max(df.filter("v < 1"), "v").first().scale_max == 1.0


def test_check_single_value(spark):
    ok = spark.createDataFrame([("x",), (None,)], "metric string")
    files.check_single_value(ok, "metric", "x", "ok.csv")
    with pytest.raises(files.MetricDomainError):
        files.check_single_value(spark.createDataFrame([(None,)], "metric string"),
                                 "metric", "x", "nulls.csv")


def test_one_row_combines_without_joins(spark):
    from snapmart.plans.serving import one_row

    a = spark.createDataFrame([(3, None)], "n long, label string")
    b = spark.createDataFrame([(1.5,)], "total double")
    row = one_row(a, b)
    assert row.columns == ["n", "label", "total"]
    assert tuple(row.first()) == (3, None, 1.5)
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_the_manifest_is_read_as_written_and_the_report_is_made_once(spark, monkeypatch):
    from snapmart.plans import catalog, medallion
    from tests.conftest import SF_SMALL

    checked = spark.sparkContext.accumulator(0)
    made = medallion.activity_quality

    def counted(bronze):
        def count(batches):
            for batch in batches:
                checked.add(batch.num_rows)
                yield batch

        report = made(bronze)
        return report.mapInArrow(count, report.schema)

    monkeypatch.setattr(medallion, "activity_quality", counted)
    manifest = catalog.QUERIES["run_manifest"](spark, SF_SMALL)
    row = manifest.collect()[0]
    assert checked.value == row["quality_checks"] == row["report_rows"] == 18 and row["quality_failures"] == 0
    assert row["report_digest"] == row["report_copy_digest"] and row["fact_extracts_rows"] == row["fct_activity_rows"] > 0
    plan = manifest._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan and "run_manifest" in str(manifest.inputFiles())
