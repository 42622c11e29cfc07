"""Order-insensitive comparison of a Spark result with a DuckDB oracle query.

Used by the test-suite and by ``python -m tests.oracle <query> [sf_dir]``.
Columns are compared by name; values exactly (floats within ``rel_tol`` only
when asked).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value, float_digits: int | None):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return round(value, float_digits) if float_digits is not None else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v, float_digits) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _norm(v, float_digits)) for k, v in value.items()))
    return value


def compare(spark_df, sql: str, sf_dir: str, float_digits: int | None = None) -> list[str]:
    """Return a list of differences (empty when equal)."""
    con = duck_connection(sf_dir)
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    duck_rows = cur.fetchall()
    spark_cols = spark_df.columns
    problems = []
    if sorted(duck_cols) != sorted(spark_cols):
        return [f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}"]
    order = sorted(spark_cols)
    s_idx = [spark_cols.index(c) for c in order]
    d_idx = [duck_cols.index(c) for c in order]
    s_rows = [tuple(_norm(r[i], float_digits) for i in s_idx) for r in spark_df.collect()]
    d_rows = [tuple(_norm(r[i], float_digits) for i in d_idx) for r in duck_rows]
    if len(s_rows) != len(d_rows):
        problems.append(f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}")
    s_set, d_set = Counter(s_rows), Counter(d_rows)
    only_s = [r for r in s_set if s_set[r] != d_set.get(r, 0)]
    only_d = [r for r in d_set if d_set[r] != s_set.get(r, 0)]
    if only_s or only_d:
        problems.append(f"{len(only_s)} spark-only / {len(only_d)} duck-only rows; columns {order}")
        for r in only_s[:3]:
            problems.append(f"  spark: {r}")
        for r in only_d[:3]:
            problems.append(f"  duck : {r}")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from snapmart.session import build_session

    names = argv[1:2] or sorted(entry.oracle_sql())
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    if names == ["all"]:
        names = sorted(entry.queries())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    import time

    for name in names:
        t0 = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                print(f"{name}: rows-only ({df.count()} rows)", flush=True)
                continue
            problems = compare(df, sql, sf_dir)
        except Exception as exc:  # noqa: BLE001
            problems = [f"error: {str(exc).splitlines()[0][:300]}"]
        problems.append(f"({time.time() - t0:.1f}s)")
        status = "OK" if len(problems) == 1 else "MISMATCH"
        failed += status != "OK"
        print(f"{name}: {status}", flush=True)
        for p in problems:
            print("   ", p)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
