"""The published energy mart end to end on inline rows, against a pandas
restatement of the published formulas (brute force) and golden values."""

from __future__ import annotations

import math
import os

import numpy as np
import pytest

from snapmart.operators.marts import ENERGY_MART, build_dimension, build_mart, reference_rows
from snapmart.operators.standardize import standardize
from snapmart.sources import files

HEADER = ",".join(files.REQUIRED_COLUMNS)
URL = "https://example.org/region"

# (municipality, year, value, yoy, five-year) per metric; rates of Rocky View
# are invented for the test, the others are the published rows.
OIL = [("Opportunity No. 17", 2025, "3100000", "-3.94", "-15.1"),
       ("Bonnyville No. 87", 2025, "32500000", "8.67", "27.0"),
       ("Peace No. 135", 2025, "40395", "-23.5", "-38.3")]
GAS = [("Opportunity No. 17", 2025, "118600000", "-9.44", "-14.8"),
       ("Peace No. 135", 2025, "11400000", "-23.3", "-30.8"),
       ("Rocky View County", 2025, "1700000000", "12.5", "40.0")]
WELLS = [("Opportunity No. 17", 2024, "99", "1.02", "209.4"),
         ("Bonnyville No. 87", 2024, "286", "6.72", "-1.04"),
         ("Peace No. 135", 2024, "9", "0.0", "80.0")]


def _csv(path, metric, unit, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [HEADER] + [
        f'"{n}",{y},{metric},{v},{unit},{a},{b},Dashboard,{URL},2026-04-09,OGL,2026-07-24'
        for n, y, v, a, b in rows
    ]
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def silver(spark, workdir):
    _csv(f"{workdir}/oil.csv", "oil_production", "m3", OIL)
    _csv(f"{workdir}/gas.csv", "natural_gas_production", "m3", GAS)
    _csv(f"{workdir}/wells.csv", "well_count", "count", WELLS)
    bronze = files.load_bronze(spark, [
        files.SnapshotSource("oil", (f"{workdir}/oil.csv",), "oil_production"),
        files.SnapshotSource("gas", (f"{workdir}/gas.csv",), "natural_gas_production"),
        files.SnapshotSource("wells", (f"{workdir}/wells.csv",), "well_count"),
    ])
    return standardize(bronze)


# Worked by hand from the rows above. Every metric's least entity has 0, so a part is
# its weight times log(1 + value) / log(1 + largest): Bonnyville is largest in oil (45)
# and wells (20) and absent in gas, Rocky View largest in gas (35) and absent elsewhere.
SCORES = {"Opportunity No. 17": 85.78, "Bonnyville No. 87": 65.0, "Peace No. 135": 62.49, "Rocky View County": 35.0}
# Means of the rates of oil and gas that are present.
RATES = {"Opportunity No. 17": -6.69, "Bonnyville No. 87": 8.67, "Peace No. 135": -23.4, "Rocky View County": 12.5}


@pytest.mark.parametrize("strategy", ["join", "aggregate"])
def test_energy_mart_golden_and_hand_worked(silver, strategy):
    mart = build_mart(silver, ENERGY_MART, strategy=strategy)
    assert mart.columns == ENERGY_MART.output_columns() and len(mart.columns) == 23
    got = {r.municipality: r for r in mart.collect()}
    assert len(got) == 4
    opp = got["Opportunity No. 17"]
    assert (opp.oil_m3_2025, opp.gas_m3_2025, opp.well_count_2024) == (3_100_000, 118_600_000, 99)
    assert opp.oil_m3_2024_estimated == pytest.approx(3227149.6981053506, abs=1e-6)
    assert opp.combined_yoy_pct == pytest.approx(-6.69)
    assert opp.activity_class == "Declining"
    assert opp.municipality_key == "b5c9ef564d6b"
    bon = got["Bonnyville No. 87"]
    assert bon.gas_m3_2025 == 0.0 and bon.gas_m3_2024_estimated is None
    assert bon.gas_m3_per_reported_well == 0.0 and bon.activity_class == "Expanding"
    rocky = got["Rocky View County"]
    assert rocky.oil_m3_per_reported_well is None and rocky.gas_m3_per_reported_well is None
    assert rocky.energy_activity_score == 35.0 and rocky.activity_class == "Expanding"
    assert rocky.oil_year is None and rocky.gas_year == 2025
    assert {n: r.energy_activity_score for n, r in got.items()} == SCORES
    assert {n: round(r.combined_yoy_pct, 6) for n, r in got.items() if r.combined_yoy_pct is not None} == RATES


def test_dimension_keeps_first_source_name(spark):
    rows = [("k1", "Zeta", "oil_production", 2025), ("k1", "Alpha", "well_count", 2024),
            ("k2", "Beta", "well_count", 2024), ("k2", "Aaa", "well_count", 2024)]
    df = spark.createDataFrame(rows, "municipality_key string, municipality string, "
                                     "metric string, year int")
    dim = {r[0]: r[1] for r in build_dimension(reference_rows(df, ENERGY_MART),
                                               ENERGY_MART).collect()}
    assert dim == {"k1": "Zeta", "k2": "Aaa"}


def test_constant_column_scales_to_zero_and_negatives_clip(spark):
    from snapmart.operators.marts import ACTIVITY_MART

    rows = []
    for i, name in enumerate(["a", "b", "c"]):
        key = f"k{i}"
        rows.append((key, name, 2000, "billed", [5.0, -3.0, 50.0][i], None, None))
        rows.append((key, name, 2000, "returned_qty", 7.0, 1.0, None))
        rows.append((key, name, 1999, "order_count", 2.0, None, None))
    df = spark.createDataFrame(rows, "entity_key string, entity string, year int, metric string, "
                                     "value double, yoy_change_pct double, "
                                     "five_year_change_pct double")
    got = {r.entity: r for r in build_mart(df, ACTIVITY_MART).collect()}
    # returned_qty and order_count are constant: spread 0 -> contribute 0
    lo, hi = math.log1p(0.0), math.log1p(50.0)
    for name, v in (("a", 5.0), ("b", 0.0), ("c", 50.0)):
        expect = np.round(45 * (math.log1p(v) - lo) / (hi - lo), 2)
        assert got[name].activity_score == expect
    assert 0.0 <= min(r.activity_score for r in got.values())
    assert got["a"].activity_class == "Stable"


def test_join_strategy_fans_out_on_duplicate_keys(spark):
    from snapmart.operators.marts import ACTIVITY_MART

    rows = [("k", "Same", 2000, "billed", 1.0, None, None),
            ("k", "Same ", 2000, "billed", 2.0, None, None)]
    df = spark.createDataFrame(rows, "entity_key string, entity string, year int, metric string, "
                                     "value double, yoy_change_pct double, "
                                     "five_year_change_pct double")
    assert build_mart(df, ACTIVITY_MART, "join").count() == 2
    assert build_mart(df, ACTIVITY_MART, "aggregate").count() == 1


def test_silver_keeps_last_line_of_the_file(spark, workdir):
    rows = [("Dup Town", 2025, "5", "1.0", "1.0"), ("Dup Town", 2025, "9", "1.0", "1.0"),
            ("Dup Town", 2025, "7", "1.0", "1.0"), ("Other", 2025, "1", "2.0", "2.0")]
    _csv(f"{workdir}/oil.csv", "oil_production", "m3", rows)
    bronze = files.load_bronze(spark, [
        files.SnapshotSource("oil", (f"{workdir}/oil.csv",), "oil_production")])
    silver = {r.municipality: r for r in standardize(bronze).collect()}
    assert silver["Dup Town"].value == 7.0  # last line, not the largest value
    assert len(silver) == 2


def test_snapshot_run_end_to_end(spark, workdir):
    from snapmart.operators.quality import QualityGateError
    from snapmart.plans.medallion import ENERGY_GOLD_NAMES, run_snapshot

    _csv(f"{workdir}/src/oil.csv", "oil_production", "m3", OIL)
    _csv(f"{workdir}/src/gas.csv", "natural_gas_production", "m3", GAS)
    _csv(f"{workdir}/src/wells.csv", "well_count", "count", WELLS)
    sources = [
        files.SnapshotSource("oil", (f"{workdir}/src/oil.csv",), "oil_production"),
        files.SnapshotSource("gas", (f"{workdir}/src/gas.csv",), "natural_gas_production"),
        files.SnapshotSource("wells", (f"{workdir}/src/wells.csv",), "well_count"),
    ]
    manifest = run_snapshot(spark, sources, f"{workdir}/out").first()
    assert manifest.gold_tables == sorted(ENERGY_GOLD_NAMES)
    assert manifest.row_counts == {"dim_municipality": 4, "fct_energy_activity": 9,
                                   "mart_municipality_energy_summary": 4}
    assert (manifest.quality_checks, manifest.quality_failures) == (18, 0)
    mart = spark.read.parquet(f"{workdir}/out/warehouse/gold/parquet/"
                              "mart_municipality_energy_summary")
    opp = mart.filter("municipality = 'Opportunity No. 17'").first()
    assert opp.oil_m3_2025 == 3_100_000 and opp.activity_class == "Declining"
    assert os.listdir(f"{workdir}/out/warehouse/extracts/fact_by_metric")

    bad = [("Bad Place", 2025, "-5", "1.0", "1.0")]
    _csv(f"{workdir}/src2/oil.csv", "oil_production", "m3", bad)
    with pytest.raises(QualityGateError):
        run_snapshot(spark, [files.SnapshotSource(
            "oil", (f"{workdir}/src2/oil.csv",), "oil_production")], f"{workdir}/out2")
    assert any(f.endswith(".csv") for f in os.listdir(
        f"{workdir}/out2/results/data_quality_report"))


def test_extrema_start_no_job(spark, workdir):
    """The score's extrema are a subquery of the mart's plan."""
    from snapmart.operators.marts import ACTIVITY_MART, add_score

    wide = spark.createDataFrame([(float(i), float(i * 2), float(i % 7)) for i in range(1, 50)], ", ".join(
        f"{m.value_column} double" for m in ACTIVITY_MART.metrics))
    sc = spark.sparkContext
    sc.setJobGroup("extrema", "")
    try:
        scored = add_score(wide, ACTIVITY_MART)
        assert not sc.statusTracker().getJobIdsForGroup("extrema")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert scored.where(f"{ACTIVITY_MART.score_col} between 0 and 100").count() == 49
