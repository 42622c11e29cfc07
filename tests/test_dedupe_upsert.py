"""De-duplication determinism and the upsert semantics."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from snapmart.operators.dedupe import duplicate_rows, keep_any, keep_first, keep_last
from snapmart.operators.upsert import DuplicateSourceKeyError, keys_may_repeat, upsert


def test_keep_last_two_and_three_duplicates(spark):
    rows = [("a", 2025, 1, "x"), ("a", 2025, 2, "y"), ("b", 2025, 1, "p"), ("b", 2025, 2, "q"),
            ("b", 2025, 3, "r"), ("c", 2024, 1, "z")]
    df = spark.createDataFrame(rows, "m string, year int, seq int, v string")
    got = sorted(tuple(r) for r in keep_last(df, ["m", "year"], ["seq"]).collect())
    assert got == [("a", 2025, 2, "y"), ("b", 2025, 3, "r"), ("c", 2024, 1, "z")]
    first = sorted(tuple(r) for r in keep_first(df, ["m", "year"], ["seq"]).collect())
    assert first == [("a", 2025, 1, "x"), ("b", 2025, 1, "p"), ("c", 2024, 1, "z")]


def test_keep_last_full_tie_break_is_partition_independent(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 3), rnd.choice("abcdef")) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    a = sorted(tuple(r) for r in keep_last(df.repartition(1), ["k"], ["seq"]).collect())
    b = sorted(tuple(r) for r in keep_last(df.repartition(13), ["k"], ["seq"]).collect())
    assert a == b
    assert len(a) == len({r[0] for r in rows})
    # brute force: max (seq, v) per key
    best = {}
    for k, s, v in rows:
        best[k] = max(best.get(k, (s, v)), (s, v))
    assert a == sorted((k, s, v) for k, (s, v) in best.items())


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"), (F.col("id") * 7919 % 30_011).alias("seq"),
        F.col("id").cast("string").alias("v")).repartition(6)
    for kept, pick in ((keep_last(rows, ["k"], ["seq"]), F.max), (keep_first(rows, ["k"], ["seq"]), F.min)):
        want = rows.groupBy("k").agg(pick("seq").alias("seq"))
        assert {(r["k"], r["seq"]) for r in kept.collect()} == {(r["k"], r["seq"]) for r in want.collect()}
        plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        limits = plan.split("WindowGroupLimit")
        assert "SortAggregate" not in plan and len(limits) == 3 and "Exchange hashpartitioning(k" in limits[1]


def test_keep_last_orders_nulls_lowest_and_nan_highest(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 2.0, "b"), (2, None, "n"), (3, float("nan"), "x"), (3, 5.0, "y")], "k int, seq double, v string")
    assert sorted((r["k"], r["v"]) for r in keep_last(df, ["k"], ["seq"]).collect()) == [(1, "b"), (2, "n"), (3, "x")]
    assert sorted((r["k"], r["v"]) for r in keep_first(df, ["k"], ["seq"]).collect()) == [(1, "n"), (2, "n"), (3, "y")]


def test_keep_any_and_duplicate_count(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "x"), (None, "y")],
                               "k int, v string")
    assert sorted((tuple(r) for r in keep_any(df, ["k"]).collect()), key=str) == sorted(
        [(1, "a"), (2, "c"), (None, "x")], key=str)
    assert duplicate_rows(df, ["k"]).first()[0] == 2


def test_keep_last_needs_ordering(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        keep_last(df, ["k"], [])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_matched_inserted_target_only_and_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c"), (None, "s")], "k int, v string")
    got = _rows(upsert(target, source, ["k"]))
    assert got == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "t"), (None, "s")], key=str)


def test_upsert_is_idempotent_for_non_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    assert _rows(once) == _rows(twice)


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(DuplicateSourceKeyError):
        upsert(target, source, ["k"])


def test_upsert_schema_evolution(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "old")],
                                   "k int, v string, t_only string")
    source = spark.createDataFrame([(2, "B", 20), (3, "c", 30)], "k int, v string, s_only int")
    out = upsert(target, source, ["k"])
    assert out.columns == ["k", "v", "t_only", "s_only"]
    assert _rows(out) == sorted([(1, "a", "keep", None), (2, "B", "old", 20),
                                 (3, "c", None, 30)], key=str)


def test_upsert_multi_column_key(spark):
    target = spark.createDataFrame([("a", 2024, 1.0), ("a", 2025, 2.0)], "m string, y int, v double")
    source = spark.createDataFrame([("a", 2025, 5.0)], "m string, y int, v double")
    got = _rows(upsert(target, source, ["m", "y"]).orderBy(F.col("y")))
    assert got == [("a", 2024, 1.0), ("a", 2025, 5.0)]


def test_a_unique_target_is_merged_without_shuffling_the_source(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "t", 3), (4, None, 4)], "k int, v string, w int")
    source = spark.createDataFrame([("B", 2, "new", 2.5), ("c", 3, None, 3.0), ("s", None, "n", 1.0)], "v string, k int, x string, w double")
    out = upsert(target, source, ["k"], unique_target=True)
    want = upsert(target, source, ["k"])
    assert out.dtypes == want.dtypes and _rows(out) == _rows(want) and len(_rows(out)) == 6
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "FullOuter" not in plan
    # a column of the target's own is kept on update: both sides are joined whole
    wider = target.withColumn("own", F.lit("o"))
    assert _rows(upsert(wider, source, ["k"], unique_target=True)) == _rows(upsert(wider, source, ["k"]))


def test_repeated_keys_are_found_by_hash(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (None, "a"), (3, None), (3, None)], "k int, p string")
    assert not keys_may_repeat(df, ["k", "p"])
    assert keys_may_repeat(df, ["k", "p"], nulls_match=["p"]) and keys_may_repeat(df, ["p"])
    assert not keys_may_repeat(df.where("p is not null"), ["k", "p"], nulls_match=["p"])
    assert not keys_may_repeat(df.limit(0), ["k"])
