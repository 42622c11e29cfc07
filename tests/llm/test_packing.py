from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmart.llm import packing
from snapmart.llm.queries import PACK_TOKENIZER, op2_packing
from tests.conftest import SF_SMALL
from tests.llm.brute import crc_of_ids, documents, edge_rows

PATH = public_tokenizers.path(PACK_TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(pieces, texts, tokenizer, size=4096):
    """Pieces cover each document once, in gapless sequences that need no padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    assert by_doc.keys() == ids.keys()
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[doc])
            assert p["crc"] == crc_of_ids(ids[doc][at : at + p["length"]])
            at += p["length"]
        assert at == len(ids[doc])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size and at & (at - 1) == 0


def test_edge_rows(spark, tokenizer):
    texts = dict(edge_rows()[:3] + edge_rows()[6:])
    made = packing.pack(documents(spark, list(texts.items()), extra=True), PATH).withColumn("crc", F.crc32("ids"))
    check(made.collect(), texts, tokenizer)


def test_repeated_and_null_ids_are_packed_each(spark):
    made = packing.pack(documents(spark, [(4, "one"), (4, "one"), (None, "two")]), PATH).collect()
    assert sorted((p["doc_id"] or 0, p["start"], p["length"]) for p in made) == [(0, 0, 2), (4, 0, 2), (4, 0, 2)]


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_many_copies_spread_over_sequences(spark, tokenizer):
    texts = {i: "the same words again and again" for i in range(3000)}
    made = packing.pack(documents(spark, list(texts.items())), PATH, size=64).withColumn("crc", F.crc32("ids")).collect()
    check(made, texts, tokenizer, size=64)


def test_word_tokenizer_is_the_tokenizer(tokenizer):
    own = packing.WordTokenizer(PATH)
    for text in (
        "It's we'll don't 'S ''s o'clock's", "Élan Ñandú ß ÀÖØ ž İstanbul ſ ŉ", "a_b-c__d 12.5% (x)²³ ½", "tab\tnew\r\nline\x0b\x0c\x1c\x85  end",
        "é combining", "Σίσυφος ΟΔΟΣ", "日本語 \U0001f600\U0001f600", "<|endoftext|>x<|startoftext|> <|endoftext", "", "  ", "×÷ª º µ",
    ):
        assert np.frombuffer(own.ids(text), dtype=own.dtype).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_hilbert_curve_visits_each_cell_once_and_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = packing.hilbert_key(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark):
    """Languages stay together: far fewer changes along the order than by chance."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 400")
    lang = dict(docs.select("doc_id", "lang").collect())
    order = [r[0] for r in packing.pack(docs, PATH).where("start = 0").orderBy("hilbert_key").select("doc_id").collect()]
    changes = sum(lang[a] != lang[b] for a, b in zip(order, order[1:]))
    share = [list(lang.values()).count(v) / len(lang) for v in set(lang.values())]
    assert changes < 0.6 * len(order) * (1 - sum(s * s for s in share))


def test_query(spark, tokenizer):
    texts = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    made = op2_packing(spark, SF_SMALL).withColumnRenamed("ids_crc32", "crc")
    check(made.collect(), texts, tokenizer)
