"""Keyed upsert with schema evolution.

``MERGE .. WHEN MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL`` expressed as
one full outer join on the keys plus a per-column choice:

* key columns: the source's, else the target's;
* columns in the source: the source value when the row came from the source,
  else the target's (target-only rows stay as they were);
* target-only columns (schema evolution): kept on update, null on insert;
* source-only columns: appended after the target's columns, null for
  target-only rows.

Plain ``=`` on the keys, as in SQL MERGE: a null key never matches, so such
source rows are inserted again on every run. Callers that need idempotency
(the incremental ingest) reject null keys first. Several source rows for one
key are rejected (a MERGE would fail on them too).

At scale both sides shuffle on the keys once (sort-merge join). Where the target
holds each key once and has no columns of its own, a matched row is the source's
row whole: then the source isn't shuffled but for its keys, and the target's rows without
a match are appended (``unique_target``). Partitioning
the stored target by a key bucket (:func:`key_bucket`) or a natural partition
column bounds what a batch reads and rewrites to the partitions it touches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SRC, _TGT = "__from_source", "__from_target"


class DuplicateSourceKeyError(ValueError):
    pass


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def keys_may_repeat(df: DataFrame, keys: Sequence[str], nulls_match: Sequence[str] = ()) -> bool:
    """False if no two rows share a non-null key. Only 64-bit hashes of the keys are shuffled,
    so two keys of one hash may give True as well: :func:`assert_unique_keys` is exact.

    Nulls in the columns ``nulls_match`` count as equal.
    """
    present = [k for k in keys if k not in nulls_match]
    rows = df.filter(_all_present(present)) if present else df
    repeated = rows.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return bool(repeated.limit(1).collect())


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two source rows share a non-null key (one small action; a second one if hashes of keys repeat)."""
    if not keys_may_repeat(source, keys):
        return
    dup = (
        source.filter(_all_present(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .limit(1)
        .collect()
    )
    if dup:
        shown = {k: dup[0][k] for k in keys}
        raise DuplicateSourceKeyError(f"source has several rows for key {shown}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check_duplicates: bool = True,
    unique_target: bool = False,
) -> DataFrame:
    """The target after merging ``source`` into it on ``keys`` (see module notes).

    ``unique_target`` says that no two target rows share a non-null key.
    """
    if check_duplicates:
        assert_unique_keys(source, keys)
    t_cols, s_cols = target.columns, source.columns
    # a column of both sides takes the wider of its types (a union finds it, or raises)
    shared = [c for c in t_cols if c in s_cols]
    wide = dict(target.select(*shared).limit(0).unionByName(source.select(*shared).limit(0)).dtypes)
    t = target.select(*[F.col(c).cast(wide.get(c, t)).alias(f"t_{c}") for c, t in target.dtypes],
                      F.lit(True).alias(_TGT))
    s = source.select(*[F.col(c).cast(wide.get(c, t)).alias(f"s_{c}") for c, t in source.dtypes],
                      F.lit(True).alias(_SRC))
    cond = reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys])
    if unique_target and set(t_cols) <= set(s_cols):
        columns = [*t_cols, *(c for c in s_cols if c not in t_cols)]
        only = t.join(s.select(*[f"s_{k}" for k in keys]), cond, "left_anti")
        return s.select(*[F.col(f"s_{c}").alias(c) for c in columns]).unionByName(
            only.select(*[F.col(f"t_{c}").alias(c) for c in t_cols]), allowMissingColumns=True)
    joined = t.join(s, cond, "full_outer")
    from_source = F.coalesce(F.col(_SRC), F.lit(False))
    out = []
    for c in t_cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"s_{c}"), F.col(f"t_{c}")).alias(c))
        elif c in s_cols:
            out.append(F.when(from_source, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        else:
            out.append(F.col(f"t_{c}").alias(c))
    out += [F.col(f"s_{c}").alias(c) for c in s_cols if c not in t_cols]
    return joined.select(*out)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Stable bucket of the merge key: ``pmod(xxhash64(keys), buckets)``.

    A partition column for tables whose keys have no natural one.
    """
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
