"""Driver contract: entry() and every registered query against its oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from snapmart.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle import compare

ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k in catalog.QUERIES}


def test_entry_returns_rows(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "activity_score" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(ORACLE)
    assert set(catalog.QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    assert compare(df, ORACLE[name], SF_SMALL) == []


def test_activity_mart_matches_independent_dry_run(spark):
    """Figures of an independent DuckDB dry run at sf0.01."""
    from pyspark.sql import functions as F

    mart = entry_module.queries()["mart_entity_summary"](spark, "/root/testdata/sf0.01").cache()
    assert mart.count() == 1255
    classes = {r[0]: r[1] for r in mart.groupBy("activity_class").count().collect()}
    assert classes == {"Declining": 342, "Stable": 27, "Expanding": 374, "Not comparable": 512}
    present = [mart.filter(F.col(c).isNotNull()).count()
               for c in ("billed_year", "returned_qty_year", "order_count_year")]
    assert present == [610, 1023, 605]
