"""Rankings, positions and top-k lists.

``dense_rank`` per metric is the textbook case of a window with few, huge
partitions: ``Window.partitionBy("metric")`` would sort a third of the table in
one task. :func:`dense_rank_by` gives every row a range of its group instead, by
bounds that a quantile sketch found, so that the rows of one hot value lie in several
ranges; it ranks inside each (group, range), and adds an offset from a table
that has one row per (group, range). Only the bounds are written, never the rows. :func:`with_position`
numbers rows in a total order by a range shuffle. Nothing is ever dealt out or joined by the value.

Top-k uses ``row_number() <= k`` over a partitioned window, which Catalyst
plans as a partial ``WindowGroupLimit`` before the shuffle: each map task
forwards at most k rows per group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ID_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    return num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _nulls_last(name: str, descending: bool = False) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


#: Types of which Spark sketches quantiles.
_SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _is_sketched(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _SKETCHED)


def _bounds(df: DataFrame, groups: Sequence[str], names: Sequence[str], order_col: str, descending: bool, ranges: int) -> DataFrame:
    """(group, array of range bounds in order, number of ranges that its nulls deserve), one row per group, written.

    Written, because a sketch may differ between two runs, and all readers must see the same ranges.
    """
    from snapmart.sources.sinks import stage_table

    value, none = F.col(order_col), F.array().cast(T.ArrayType(df.schema[order_col].dataType))
    shares = [i / ranges for i in range(1, ranges)]
    found = F.approx_percentile(value, shares, max(10_000, 4 * ranges)) if shares else F.max(none)
    nulls = F.count_if(value.isNull()) / F.greatest(F.count(F.lit(1)), F.lit(1))
    sketched = df.groupBy(*[F.col(g).alias(n) for g, n in zip(groups, names)]).agg(
        F.sort_array(F.coalesce(found, none), asc=not descending).alias("__bounds"),
        F.greatest(F.ceil(nulls * ranges), F.lit(1)).alias("__null_ranges"))
    return stage_table(sketched, "rank-bounds")


def _count_before(bounds: Column, holds: Callable[[Column], Column], ranges: int) -> Column:
    """How many bounds, from the first, ``holds`` is true of: found by halving."""
    steps = [1 << i for i in range(ranges.bit_length(), -1, -1)]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(bounds)) & F.coalesce(holds(F.get(bounds, at + step - 1)), F.lit(False)), at + step).otherwise(at))


def ranged(
    df: DataFrame, groups: Sequence[str], order_col: str, descending: bool = True, num_partitions: int | None = None
) -> DataFrame:
    """``df`` with ``__part``: the number of a row's range among its group's, ascending in the stated order.

    A group has ``num_partitions`` ranges of about the same size. A value that
    fills several of them has its rows spread over these by a hash of the row, and so have nulls, which
    come last: only rows that agree in every column must stay together. Values without a
    quantile sketch (texts, say) are range-partitioned over all groups instead.
    """
    ranges = _partitions(df, num_partitions)
    if not _is_sketched(df, order_col):
        order = [*[_nulls_last(g) for g in groups], _nulls_last(order_col, descending)]
        return df.repartitionByRange(ranges, *order, F.xxhash64(*df.columns).asc()).withColumn("__part", F.spark_partition_id())
    names = [f"__b{i}" for i in range(len(groups))]
    bounds = _bounds(df, groups, names, order_col, descending, ranges)
    if groups:
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(groups, names)])
        rows, cuts, null_ranges = df.join(bounds, same), F.col("__bounds"), F.col("__null_ranges")
    else:
        one = bounds.first()  # a row of at most ``ranges`` bounds
        cuts = F.array(*map(F.lit, one["__bounds"])).cast(bounds.schema["__bounds"].dataType)
        rows, null_ranges = df, F.lit(one["__null_ranges"])
    value, draw = F.col(order_col), F.xxhash64(*[df[c] for c in df.columns])
    low = _count_before(cuts, (lambda b: b > value) if descending else (lambda b: b < value), ranges)
    high = _count_before(cuts, (lambda b: b >= value) if descending else (lambda b: b <= value), ranges)
    placed = rows.select(*df.columns, F.when(value.isNull(), ranges + F.pmod(draw, null_ranges)).otherwise(
        F.element_at(F.transform(F.array(F.struct(low.alias("low"), high.alias("high"))), lambda r: r["low"] + F.pmod(draw, r["high"] - r["low"] + 1)), 1)
    ).cast("long").alias("__part"))
    return placed


def dense_rank_by(
    df: DataFrame,
    partition_by: Sequence[str],
    order_col: str,
    rank_col: str = "rank",
    descending: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` = SQL ``dense_rank() over (partition by .. order by order_col)``.

    Nulls rank last in both directions (the SQL default for DESC in most
    engines; stated explicitly here so ascending ranks agree too).

    Steps: give each row a range (:func:`ranged`); dense rank inside each
    (group, range), each of which is one task's share; per (group, range)
    the number of values with the first and last one; prefix sums per group over
    that small table, less one wherever a value continues from the range before;
    add the offset. The join is on (group, range): a hot value's rows are spread
    over its ranges. Nothing is collected.

    ``df`` is read three times, twice for a few columns only; a costly plan is best
    given as a written layer. Ranges of values without a sketch aren't the same in two runs, so such rows are written.
    """
    from snapmart.sources.sinks import stage_table

    groups = list(partition_by)
    # renamed copies, so that the join back never sees two lineages of one column
    own, g_names = [f"__g{i}_row" for i in range(len(groups))], [f"__g{i}" for i in range(len(groups))]
    inside = Window.partitionBy(*own, "__part").orderBy(_nulls_last(order_col, descending))
    located = ranged(df, groups, order_col, descending, num_partitions).select(
        *df.columns, *[F.col(g).alias(n) for g, n in zip(groups, own)], "__part"
    ).withColumn("__local", F.dense_rank().over(inside).cast("long"))
    if not _is_sketched(df, order_col):
        located = stage_table(located, "ranked")

    value, low, high = F.col("__v"), F.min("__v"), F.max("__v")
    first, last = (high, low) if descending else (low, high)
    spans = located.select(
        F.col("__part").alias("__opart"), *[F.col(n).alias(g) for n, g in zip(own, g_names)],
        F.col(order_col).alias("__v"), "__local",
    ).groupBy("__opart", *g_names).agg(
        F.max("__local").alias("__n"), first.alias("__first"),
        F.when(F.count_if(value.isNull()) == 0, last).alias("__last"),
    )
    along = Window.partitionBy(*(g_names or [F.lit(0)])).orderBy("__opart")
    carried = spans.withColumn("__carried", F.when(
        (F.row_number().over(along) > 1) & F.col("__first").eqNullSafe(F.lag("__last").over(along)), 1,
    ).otherwise(0).cast("long"))
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = carried.select(
        "__opart", *g_names, (F.sum(F.col("__n") - F.col("__carried")).over(so_far) - F.col("__n")).alias("__off"))
    cond = [F.col("__part") == F.col("__opart")]
    cond += [F.col(n).eqNullSafe(F.col(g)) for n, g in zip(own, g_names)]
    # ``offsets`` has one row per (range, group): small, AQE broadcasts it.
    return located.join(offsets, on=reduce(lambda a, b: a & b, cond)).select(
        *df.columns, (F.col("__local") + F.col("__off")).alias(rank_col))


def with_position(
    df: DataFrame, order_by: Sequence[Column], position_col: str = "position", num_partitions: int | None = None,
    runs: Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based position of every row in a total order.

    ``order_by`` should end in a full tie-break; rows that agree in all of it get
    neighbouring positions in no stated order. One range shuffle and a written
    table; the offsets have one row per range.

    ``runs`` are for rows that lie in runs already, as the lines of a file's blocks do: the
    columns of ``order_by`` (ascending, nulls first), the last of them a number that counts the rows of a run without a gap.
    Such rows are neither sorted nor dealt out: they are written once, and the offsets have one row per run.
    If a run has a gap, all rows are numbered by ranges.
    """
    from snapmart.sources.sinks import stage_table

    if runs:
        *names, number = runs
        written = stage_table(df, "positions")
        opened = [F.col(c).alias(f"__r{i}") for i, c in enumerate(names)]
        own = [f"__r{i}" for i in range(len(names))]
        sizes = stage_table(written.groupBy(*opened).agg(
            F.min(number).alias("__low"), F.max(number).alias("__high"), F.count(F.lit(1)).alias("__n"), F.count(number).alias("__numbered")), "position-runs")
        gapless = (F.col("__numbered") == F.col("__n")) & (F.col("__high") - F.col("__low") + 1 == F.col("__n"))
        if sizes.where(~gapless | gapless.isNull()).limit(1).count():
            return with_position(written, order_by, position_col, num_partitions)
        before = Window.partitionBy(F.lit(0)).orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*own, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__low") + 1).alias("__off"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(r)) for c, r in zip(names, own)])
        return written.join(offsets, same).select(*df.columns, (F.col(number) + F.col("__off")).cast("long").alias(position_col))

    parts = _partitions(df, num_partitions)
    ordered = stage_table(
        df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
        .withColumn("__id", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("__id", _ID_BITS)
    sizes = ordered.groupBy(part.alias("__opart")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__opart").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__opart", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = F.col("__id") - F.shiftleft(part, _ID_BITS) + F.col("__off") + 1
    return ordered.join(offsets, part == F.col("__opart")).select(*df.columns, place.cast("long").alias(position_col))


def top_k(
    df: DataFrame,
    k: int,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    position_col: str = "position",
) -> DataFrame:
    """First ``k`` rows per group under ``order_by`` (a full tie-break is the
    caller's duty), with their 1-based position. ``k`` is the feature here."""
    if partition_by:
        window = Window.partitionBy(*partition_by).orderBy(*order_by)
        ranked = df.withColumn(position_col, F.row_number().over(window))
        # filter on the window value first so Catalyst plans WindowGroupLimit
        return ranked.filter(F.col(position_col) <= k).withColumn(
            position_col, F.col(position_col).cast("long"))
    limited = df.orderBy(*order_by).limit(k)  # TakeOrderedAndProject
    # The window only ever sees the k surviving rows.
    return limited.withColumn(
        position_col,
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order_by)).cast("long"),
    )
