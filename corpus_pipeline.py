"""A training corpus in five stages, each one of the operators applied to what the stage before kept.

Every stage reads the Parquet that its predecessor wrote, so a lost executor never
costs more than a stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import decontaminate, line_crf, packing, secret_scan, simhash
from snapmart.llm.common import free_name
from snapmart.llm.queries import PACK_TOKENIZER
from snapmart.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier finds good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return line_crf.keep_good(docs, line_crf.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    return decontaminate.drop_copies(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark and n_chars to match."""
    spans = free_name(docs, "secret_spans")
    clean = secret_scan.redact(secret_scan.scan(docs, out_col=spans), spans_col=spans)
    return clean.withColumn("n_chars", F.when(
        F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).drop(spans)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens, near-by documents together."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(PACK_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("packing", pack),
]

#: No SQL: the classifier is fitted iteratively, and SQL has neither the tokenizer nor the fingerprints' hash.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on ``documents``, each written and read again before the next."""
    root = scratch_path(spark, f"corpus-{uuid.uuid4().hex[:8]}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, step) in enumerate(STAGES):
        step(spark, docs, sf_dir).write.parquet(f"{root}/{at}")
        docs = spark.read.parquet(f"{root}/{at}")
    return docs
