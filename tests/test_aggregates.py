"""Sums and means that don't depend on the order of the rows."""

from __future__ import annotations

import math
import random

from snapmart.operators import aggregates
from snapmart.plans import catalog
from tests.conftest import SF_SMALL


def test_sums_of_doubles_without_an_order(spark):
    rng = random.Random(3)
    rows = [(i % 5, rng.choice((1, -1)) * rng.random() * 10.0 ** rng.randrange(-6, 15)) for i in range(4000)]
    rows += [(0, None), (7, None), (8, math.inf), (8, 1.0), (9, math.nan), (9, 1.0), (10, 1e300), (10, -1e300), (10, 0.25),
             (11, 1e17), (11, 2.0**53 + 2), (11, -1e17), (12, 0.1), (12, -0.1), (12, 2.0**-70), (13, -0.5), (13, 0.25)]
    seen = []
    for partitions in (1, 7, 40):
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, x double").repartition(partitions)
        got = frame.groupBy("k").agg(aggregates.order_free_sum("x").alias("s"), aggregates.order_free_avg("x").alias("m")).collect()
        seen.append(sorted((r["k"], repr(r["s"]), repr(r["m"])) for r in got))
    assert seen[0] == seen[1] == seen[2]
    total = {k: (None if s == "None" else float(s), None if m == "None" else float(m)) for k, s, m in seen[0]}
    for k in range(5):
        xs = [x for j, x in rows if j == k and x is not None]
        exact = math.fsum(xs)
        assert abs(total[k][0] - exact) <= 4 * math.ulp(math.fsum(map(abs, xs)))
        assert total[k][1] == total[k][0] / len(xs)
    assert total[7] == (None, None) and total[8][0] == math.inf and math.isnan(total[9][0])
    assert total[10][0] == 0.25 and total[11][0] == 2.0**53 + 2 and total[12][0] == 2.0**-70 and total[13] == (-0.25, -0.125)


def test_means_are_those_of_plain_doubles(spark):
    """The mean rates against a mean that cuts nothing: the engine's own compensated sum."""
    from oracle.duckdb_sql import FACT_CTE, SILVER_CTE, STG_CTE, with_activity
    from tests.oracle import duck_connection

    sql = with_activity("SELECT metric, year, favg(yoy_change_pct), favg(five_year_change_pct) FROM stg GROUP BY metric, year",
                        SILVER_CTE, FACT_CTE, STG_CTE)
    want = {(m, y): means for m, y, *means in duck_connection(SF_SMALL).execute(sql).fetchall()}
    got = catalog.q_metric_summary(spark, SF_SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        for mean, plain in zip((r["average_yoy_change_pct"], r["average_five_year_change_pct"]), want[r["metric"], r["year"]]):
            assert (mean is None) == (plain is None) and (mean is None or abs(mean - plain) <= 1e-13 * abs(plain))
