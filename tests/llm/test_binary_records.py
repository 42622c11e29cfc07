from __future__ import annotations

import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapmart.llm import binary_records as br
from snapmart.llm.queries import RECORD_TOKENIZER, op12_binary_records
from tests.conftest import SF_SMALL
from tests.llm.brute import crc_of_ids, documents, edge_rows

PATH = public_tokenizers.path(RECORD_TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
OWN = br.ByteTokenizer(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85\xa0 　᠎﻿ab'sé1<|>"), st.characters(codec="utf-8")), max_size=40))
def test_ids_equal_the_librarys(text):
    assert OWN.ids(text) == OWN.pack(ids_of(text))


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \t\n\r\x0b\x0cab'sdÉſ×÷1290<|>_-!"), max_size=40))
def test_ids_of_plain_texts_equal_the_librarys(text):
    assert OWN.ids(text) == OWN.pack(ids_of(text))


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "  lead\n\n\tand  trail \n", "it's  'll don't\r\n12 34", "a  b  c"])
def test_ids_of_blanks_and_special_tokens(text):
    assert OWN.ids(text) == OWN.pack(ids_of(text))


def test_frames():
    payloads = [b"", b"x", bytes(range(256)) * 10]
    data, at = b"".join(map(br.frame, payloads)), 0
    for want in payloads:
        payload, at = br.unframe(data, at)
        assert bytes(payload) == want
    assert at == len(data)
    crc = zlib.crc32(b"x")
    assert br.masked(b"x") == ((crc >> 15 | crc << 17) + 0xA282EAD8) % (1 << 32)
    record = br.frame(b"some payload")
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            br.unframe(bytes(broken))
    with pytest.raises(ValueError):
        br.unframe(record[:-1])


def test_round_trip_of_edge_rows(spark):
    """Nulls first, ascending ids, repeated rows kept, every start the sum of what stands before."""
    rows = edge_rows() + [(-5, "negative id"), (None, None)]
    files = br.write_records(documents(spark, rows, extra=True), PATH, file_bytes=20_000)
    assert files.count() > 2
    got = sorted(br.read_records(files).collect(), key=lambda r: r["start"])
    assert sorted((r["id"] is not None, r["id"] or 0) for r in got) == [(r["id"] is not None, r["id"] or 0) for r in got]
    want = sorted((i is not None, i or 0, crc_of_ids([*ids_of(t), 0]), len(ids_of(t)) + 1) for i, t in rows)
    assert sorted((r["id"] is not None, r["id"] or 0, zlib.crc32(r["ids"]), r["n_tokens"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    index = br.offset_index(files)
    assert sorted((r["start"]) for r in index.collect()) == [r["start"] for r in got]
    shuffled = [br.read_shuffled(files, seed).collect() for seed in (1, 1, 2)]
    assert shuffled[0] == shuffled[1] != shuffled[2]
    for rows in shuffled:
        assert sorted(rows, key=lambda r: r["start"]) == got


def test_many_files_and_blocks(spark):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(300)]
    files = br.write_records(documents(spark, rows).repartition(5), PATH, file_bytes=100)
    got = {r["id"]: r for r in br.read_records(files).collect()}
    at = 0
    for i, text in rows:
        assert (got[i]["start"], got[i]["n_tokens"]) == (at, len(ids_of(text)) + 1)
        at += got[i]["n_tokens"]
    placed = {(r["part"], r["number"]): r["first_token"] for r in files.collect()}
    small = br._placed(files.drop("first_token"), block=2)
    assert {(r["part"], r["number"]): r["first_token"] for r in small.collect()} == placed


def test_empty_table(spark):
    files = br.write_records(documents(spark, []), PATH)
    assert files.count() == 0 and br.read_records(files).count() == 0 and br.read_shuffled(files, 1).count() == 0


def test_a_damaged_file_fails_the_read(spark, workdir):
    files = br.write_records(documents(spark, [(1, "some text"), (2, "more")]), PATH, root=f"file:{workdir}/records")
    path = files.first()["path"].removeprefix("file:")
    data = bytearray(open(f"{path}.rec", "rb").read())
    data[13] ^= 1
    open(f"{path}.rec", "wb").write(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        br.read_records(files).collect()


def test_query(spark):
    given_rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op12_binary_records(spark, SF_SMALL).collect()}
    at = 0
    for doc_id, text in sorted(map(tuple, given_rows)):
        ids = [*ids_of(text), 0]
        assert tuple(got[doc_id]) == (doc_id, at, len(ids), crc_of_ids(ids))
        at += len(ids)
