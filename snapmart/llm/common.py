"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapmart.session import scratch_path

#: Texts handed to a vectorised kernel at once hold at most so many bytes (or are one row).
SLICE_BYTES = 4 << 20

def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    This is how lineage is cut: the files outlive any executor. They go when the
    ``session.scratch_run`` around the call ends, or the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut a batch so that each slice has about SLICE_BYTES of text; null texts become ''."""
    at = batch.schema.get_field_index(column)
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(at)), 0).cast(pa.int64()))
    ends = ends.to_pylist()
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = start + 1
        while stop < batch.num_rows and ends[stop] - base <= SLICE_BYTES:
            stop += 1
        part = batch.slice(start, stop - start)
        yield part, [t or "" for t in part.column(at).to_pylist()]
        start = stop


def map_texts(
    df: DataFrame,
    kernel: Callable[[list[str]], dict[str, object]],
    schema: str,
    text_col: str = "text",
) -> DataFrame:
    """Apply ``kernel`` (texts -> {column: values}) to every row, in Arrow batches.

    The columns of ``df`` other than the text come first, then those of ``schema``.
    """
    keep = [c for c in df.columns if c != text_col]
    new = StructType.fromDDL(schema)
    full = StructType([*df.select(*keep).schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(full)
        for batch in batches:
            for part, texts in text_slices(batch, text_col):
                made = kernel(texts)
                arrays = [part.column(part.schema.get_field_index(c)).cast(target.field(c).type) for c in keep]
                arrays += [pa.array(made[f.name], type=target.field(f.name).type) for f in new.fields]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, full)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def byte_classes() -> np.ndarray:
    """The class of every byte: lower, upper, digit, blank, stop, exclamation, symbol, other, first of a code point beyond ASCII, its rest."""
    table = np.full(256, 7, dtype=np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[*range(9, 14), 32]] = 3
    table[list(b".,;:?'\"()-")] = 4
    table[ord("!")] = 5
    table[list(b"#*$%&|<>")] = 6
    table[0xC0:] = 8
    table[0x80:0xC0] = 9
    return table


def id_crc(id_col: Column) -> Column:
    """crc32 of an id as text: the stated split of labelled rows."""
    return F.crc32(id_col.cast("string"))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    per_class: int,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, label) of at most ``per_class`` labelled documents of each class.

    Chosen by hash order of the id among the rows of ``labels`` for which
    ``learn`` (a condition on the id column) holds, so the draw does not depend
    on partitioning. An id with two labels counts as 1. The bound on the sample
    bounds the broadcast.
    """
    rows = (
        labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    )
    drawn = None
    for value in (0, 1):
        part = rows.where(F.col("label") == value).orderBy(F.xxhash64(id_col), id_col).limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    found = docs.select(id_col, text_col).join(F.broadcast(drawn), id_col)
    return found.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"), "label")
