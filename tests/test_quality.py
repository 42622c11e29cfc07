"""Quality rules on the edge rows of FIXTURES §4, the report and the gate."""

from __future__ import annotations

import os

import pytest

from snapmart.operators import quality as q
from snapmart.sources.files import REQUIRED_COLUMNS

SCHEMA = ", ".join(f"{c} string" for c in REQUIRED_COLUMNS)


def _row(**over):
    base = dict(municipality="A", year="2025", metric="oil_production", value="1", unit="m3",
                yoy_change_pct="1", five_year_change_pct="1", source_name="S",
                source_url="https://x", source_last_updated="2026-04-09", licence="L",
                snapshot_retrieved_at="2026-07-24")
    base.update(over)
    return tuple(base[c] for c in REQUIRED_COLUMNS)


def _report(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    rep = q.quality_report({"oil": df}, q.snapshot_rules(REQUIRED_COLUMNS))
    return {r.check_name: (r.status, r.failed_rows) for r in rep.collect()}


def test_all_pass(spark):
    got = _report(spark, [_row(), _row(municipality="B")])
    assert set(got) == {"required_fields_not_null", "municipality_year_unique",
                        "value_non_negative", "year_in_expected_range", "source_url_is_https",
                        "licence_present"}
    assert all(v == ("PASS", 0) for v in got.values())


def test_null_handling_differs_per_rule(spark):
    rows = [
        _row(municipality="n1", licence=None),  # null licence passes the blank rule
        _row(municipality="n2", licence="  "),  # blank licence fails
        _row(municipality="n3", source_url="http://x"),  # fails
        _row(municipality="n4", source_url=None),  # null URL fails
        _row(municipality="n5", year="1999"),
        _row(municipality="n6", year="2000"),
        _row(municipality="n7", year="2100"),
        _row(municipality="n8", year="2101"),
        _row(municipality="n9", year=None),  # null year fails
        _row(municipality="v1", value="-1"),
        _row(municipality="v2", value="0"),
        _row(municipality="v3", value=None),  # null value passes
        _row(municipality="v4", value="abc"),  # unparsable passes
    ]
    got = _report(spark, rows)
    assert got["licence_present"] == ("FAIL", 1)
    assert got["source_url_is_https"] == ("FAIL", 2)
    assert got["year_in_expected_range"] == ("FAIL", 3)
    assert got["value_non_negative"] == ("FAIL", 1)
    # null licence, null url, null year, null value
    assert got["required_fields_not_null"] == ("FAIL", 4)


def test_duplicates_count_rows_beyond_first(spark):
    rows = [_row(), _row(value="2"), _row(value="3"), _row(municipality="B"),
            _row(municipality="B"), _row(municipality=None), _row(municipality=None)]
    got = _report(spark, rows)
    assert got["municipality_year_unique"] == ("FAIL", 4)  # 2 + 1 + 1 (nulls group)


def test_empty_dataset_still_reported(spark):
    empty = spark.createDataFrame([], SCHEMA)
    full = spark.createDataFrame([_row()], SCHEMA)
    rep = q.quality_report({"oil": full, "gas": empty}, q.snapshot_rules(REQUIRED_COLUMNS))
    counts = {}
    for r in rep.collect():
        counts[r.dataset] = counts.get(r.dataset, 0) + 1
    assert counts == {"oil": 6, "gas": 6}


def test_gate_raises_after_report_is_written(spark, workdir):
    from snapmart.sources.sinks import write_csv

    df = spark.createDataFrame([_row(value="-5")], SCHEMA)
    rep = q.quality_report({"oil": df}, q.snapshot_rules(REQUIRED_COLUMNS))
    path = f"{workdir}/report"
    write_csv(rep, path)
    with pytest.raises(q.QualityGateError, match="Blocking data-quality checks failed"):
        q.enforce_gate(rep, path)
    assert any(f.endswith(".csv") for f in os.listdir(path))


def test_warning_severity_does_not_block(spark):
    df = spark.createDataFrame([_row(value="-5")], SCHEMA)
    rule = q.Rule("value_non_negative", failed=q.non_negative("value").failed, severity="WARN")
    rep = q.quality_report({"oil": df}, [rule])
    q.enforce_gate(rep)
    assert rep.first().status == "FAIL"


def test_accepted_values_and_not_null(spark):
    df = spark.createDataFrame([("oil_production",), ("coal",), (None,)], "metric string")
    rep = q.quality_report({"stg": df}, [q.column_not_null("metric"),
                                         q.accepted_values("metric", ["oil_production"])])
    got = {r.check_name: r.failed_rows for r in rep.collect()}
    assert got == {"not_null_metric": 1, "accepted_values_metric": 1}


def test_report_is_one_scan_one_shuffle(spark):
    df = spark.createDataFrame([_row()], SCHEMA)
    rep = q.quality_report(df.withColumn("dataset", __import__("pyspark.sql.functions",
                                                               fromlist=["lit"]).lit("oil")),
                           q.snapshot_rules(REQUIRED_COLUMNS))
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 2


def test_blank_check_and_strip_are_linear(spark):
    import time

    from snapmart.operators.quality import not_blank, strip_whitespace

    long_cell = "a" + " " * 100_000 + "b"
    cells = [(long_cell,), ("\u3000\t x \u00a0",), ("\u2003 \n",), ("",), (None,)]
    df = spark.createDataFrame(cells, "c string")
    start = time.monotonic()
    rows = df.select(strip_whitespace("c").alias("s"), not_blank("c").failed.alias("f")).collect()
    assert time.monotonic() - start < 20
    assert [(r.s, r.f) for r in rows] == [(long_cell, False), ("x", False), ("", True), ("", True), (None, False)]


def test_totals_are_not_rounded_unless_asked(spark):
    from snapmart.operators.aggregates import exact_sum

    df = spark.createDataFrame([(1.005,), (0.004,), (0.004,)], "v double")
    assert abs(df.agg(exact_sum("v", None)).first()[0] - 1.013) < 1e-12
    assert df.agg(exact_sum("v", 6)).first()[0] == 1.013


def test_a_named_dataset_without_rows_stays_in_the_report(spark):
    df = spark.createDataFrame([("oil", "a")], "dataset string, k string")
    report = q.quality_report(df, [q.column_not_null("k")], ["oil", "gas"])
    assert sorted((r.dataset, r.status) for r in report.collect()) == [("gas", "PASS"), ("oil", "PASS")]
