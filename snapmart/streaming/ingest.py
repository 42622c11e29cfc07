"""Incremental ingest of newly arrived files into a versioned table.

``readStream`` over a landing folder, one ``foreachBatch`` per micro-batch that
upserts into a :class:`~snapmart.sources.lake.VersionedTable`, and
``trigger(availableNow=True)`` so a scheduled run processes exactly the files
that arrived since the last run and stops. The stream checkpoint (its file
log) is the file-level watermark: a restart on the same checkpoint skips every
file already committed.

Each batch can be gated by quality rules before it is merged (the same
one-pass report and blocking gate as the batch pipeline).

A batch holds at most ``max_bytes_per_trigger`` of files, so a long backlog is merged
in several steps. ``foreachBatch`` may replay a batch after a failure: the version
written for it carries the stream's id and the batch's number, and a batch that has a version isn't merged again.
Null keys would never match, so they are rejected up front.
Within one batch several files may carry the same key: the row from the most
recently modified file wins (file path, then all columns, break ties).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators.dedupe import keep_last
from snapmart.operators.quality import Rule, enforce_gate, quality_report
from snapmart.sources.lake import VersionedTable, literal_path

#: Bytes of files in one batch, unless the caller says otherwise.
MAX_BYTES = 64 << 30

_FILE_TIME, _FILE_PATH = "__file_time", "__file_path"


class NullKeyError(ValueError):
    pass


def _stream_id(batch: DataFrame, checkpoint_location: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return batch.sparkSession.read.json(literal_path(f"{checkpoint_location.rstrip('/')}/metadata")).first()["id"]


def _batch_writer(
    target: VersionedTable,
    keys: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None,
    rules: Sequence[Rule] | None,
    report_path: str | None,
    checkpoint_location: str,
):
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = transform(batch) if transform else batch
            any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
            if rows.filter(any_null).limit(1).count():
                raise NullKeyError(f"batch {epoch_id} has rows with a null key {list(keys)}")
            if rules:
                # the batch's report is kept (one folder per epoch) before the
                # gate may stop the stream; a failed batch is not committed, so
                # a restart retries it after the files are fixed
                report = quality_report({"batch": rows}, list(rules)).withColumn(
                    "epoch", F.lit(epoch_id))
                location = f"{report_path}/epoch={epoch_id}" if report_path else None
                if location:
                    report.write.mode("overwrite").parquet(location)
                enforce_gate(report, location or f"the report of batch {epoch_id}")
            latest = keep_last(rows, list(keys), [_FILE_TIME, _FILE_PATH]).drop(
                _FILE_TIME, _FILE_PATH
            )
            # keep_last left one row per key
            target.upsert(latest, keys, check_duplicates=False, batch=f"{_stream_id(batch, checkpoint_location)}:{epoch_id}")
        finally:
            batch.unpersist()

    return write_batch


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: VersionedTable,
    keys: Sequence[str],
    checkpoint_location: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int = MAX_BYTES,
    rules: Sequence[Rule] | None = None,
    report_path: str | None = None,
) -> None:
    """Process every file in ``landing`` not yet seen by this checkpoint, then stop.

    ``rules`` gate every micro-batch (one-pass report, blocking on ERROR) before
    it is merged; ``report_path`` keeps each batch's report. A batch takes files up to
    ``max_bytes_per_trigger`` (one larger file is a batch of its own), or ``max_files_per_trigger`` if given.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    stream = reader.load(landing).select(
        "*",
        F.col("_metadata.file_modification_time").alias(_FILE_TIME),
        F.col("_metadata.file_path").alias(_FILE_PATH),
    )
    query = (
        stream.writeStream.foreachBatch(
            _batch_writer(target, keys, transform, rules, report_path, checkpoint_location))
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
