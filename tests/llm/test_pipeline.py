from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from snapmart.llm import decontaminate, line_crf
from snapmart.llm.queries import PACK_TOKENIZER
from tests.llm.brute import components, fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_against_plain_restatements(spark, workdir):
    """Every stage on what the one before kept, each against a loop over its rows."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs, rows = given, given.collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for at, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, SF).write.parquet(f"{workdir}/{at}")
        before, docs = rows, spark.read.parquet(f"{workdir}/{at}")
        rows = docs.collect()
        kept = {r["doc_id"] for r in rows}
        if name != "packing":
            assert docs.columns == given.columns and docs.dtypes == given.dtypes
        if name == "quality classifier":
            scores, _, _ = line_crf.score_texts([r["text"] or "" for r in before], line_crf.train(given, labels))
            assert kept == {r["doc_id"] for r, s in zip(before, scores) if s >= 0.7}
        elif name == "simhash near-dedup":
            prints = {r["doc_id"]: fingerprint(r["text"]) for r in before}
            root = components(prints.values())
            first: dict[int, int] = {}
            for i in sorted(prints):
                first.setdefault(root[prints[i]], i)
            assert kept == set(first.values()) and len(rows) == len(kept)
        elif name == "benchmark decontamination":
            matcher = decontaminate.Matcher(list(enumerate(items)))
            assert kept == {r["doc_id"] for r in before if not matcher.find(decontaminate.normalise(r["text"]))}
            assert not any(i in decontaminate.normalise(r["text"]) for r in rows for i in items)
        elif name == "secret scans":
            assert kept == {r["doc_id"] for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in rows if "[secret]" in r["text"])
            assert any("[secret]" in r["text"] for r in rows)
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path(PACK_TOKENIZER))
            pieces = defaultdict(list)
            for r in rows:
                pieces[r["doc_id"]].append(r)
            want = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before}
            assert {i: sum(p["length"] for p in own) for i, own in pieces.items()} == want


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_odd_tables(spark):
    """Empty tables give no rows; null texts, repeated rows and columns with the stages' own names pass every stage."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = docs.limit(0).unionByName(docs).unionByName(docs.where("doc_id < 20")).withColumn(
        "text", F.when(F.col("doc_id") % 50 == 7, None).otherwise(F.col("text"))).select(
        "*", *(F.lit(c).alias(c) for c in ("__spans", "__id", "secret_spans", "base_spans", "first_id")))
    for given in (odd, odd.limit(0)):
        rows = given
        for name, step in corpus_pipeline.STAGES:
            rows = step(spark, rows, "/root/testdata/sf0.001")
            if name != "packing":
                assert rows.columns == given.columns
        assert (rows.count() > 0) == (given is odd)
