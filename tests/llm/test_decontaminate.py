from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from snapmart.llm import decontaminate
from snapmart.llm.queries import op4_decontamination
from tests.conftest import SF_SMALL
from tests.llm.brute import documents, edge_rows, edit_matches

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@settings(max_examples=150, deadline=None)
@given(pattern=st.text("abc", min_size=1, max_size=40), text=st.text("abc", max_size=80))
def test_bit_parallel_distance(pattern, text):
    assert decontaminate.best_match(pattern, text) == edit_matches(pattern, text)


def test_pieces_cover_the_item():
    for chars in (32, 81, 226, 394):
        item = "x" * chars
        cut = decontaminate.pieces(item, decontaminate.error_budget(chars))
        assert len(cut) == decontaminate.error_budget(chars) + 1
        assert "".join(p for _, p in cut) == item and min(len(p) for _, p in cut) >= decontaminate.PIECE_CHARS


def test_every_copy_within_the_budget_is_found():
    draw = random.Random(4)
    item = decontaminate.normalise(ITEM)
    matcher, budget = decontaminate.Matcher([(7, item)]), decontaminate.error_budget(len(item))
    for edits in range(budget + 3):
        for _ in range(20):
            copy = list(item)
            for _ in range(edits):
                at = draw.randrange(len(copy))
                draw.choice((lambda: copy.insert(at, "#"), lambda: copy.pop(at), lambda: copy.__setitem__(at, "#")))()
            text = "before " * 5 + "".join(copy) + " after" * 5
            distance, _ = edit_matches(item, text)
            found = matcher.find(text)
            assert (found[7][0] == distance) if distance <= budget else not found
            if found:
                _, start, stop = found[7]
                assert edit_matches(item, text[start:stop])[0] == distance


def test_places_are_those_of_the_text_as_given(spark):
    docs = documents(spark, [(1, f"É  lead\n\n{ITEM.upper()}  tail"), (2, "clean text"), (3, ITEM.replace(" ", "\n\t "))], extra=True)
    got = {(r["doc_id"], r["item_id"], r["distance"], r["start"], r["stop"]) for r in decontaminate.find_copies(
        docs, items(spark, [(5, ITEM), (6, ITEM), (5, ITEM), (8, None), (9, ""), (10, "short")])).collect()}
    wide = len(ITEM.replace(" ", "\n\t "))
    assert got == {(1, i, 0, 9, 9 + len(ITEM)) for i in (5, 6)} | {(3, i, 0, 0, wide) for i in (5, 6)}


def test_short_items_are_found_as_whole_words(spark):
    question = "北京是哪个国家的首都以及最大的城市"
    texts = [
        "Q: what is\n the CAPITAL of Peru?", "the state of the art", "start of a cartel", f"请问{question}呢", "part art-house", "clean", None]
    docs = documents(spark, list(enumerate(texts)), extra=True)
    bench = items(spark, [(1, "What is the capital of Peru?"), (2, "art"), (3, question), (4, " "), (5, "art"), (6, "x" * 31)])
    got = {(r["doc_id"], r["item_id"], r["distance"], r["start"], r["stop"]) for r in decontaminate.find_copies(docs, bench).collect()}
    assert got == {(0, 1, 0, 3, 32), (3, 3, 0, 2, 2 + len(question))} | {(d, i, 0, at, at + 3) for d, at in ((1, 17), (4, 5)) for i in (2, 5)}
    assert {r["doc_id"] for r in decontaminate.drop_copies(docs, bench).collect()} == {2, 5, 6}


def test_blocks_give_the_same(spark, monkeypatch):
    docs = documents(spark, [(1, ITEM + ITEM[::-1])])
    bench = items(spark, [(1, ITEM), (2, ITEM[::-1])])
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 1)
    assert {r["item_id"] for r in decontaminate.find_copies(docs, bench).collect()} == {1, 2}
    assert decontaminate.drop_copies(docs, bench).count() == 0


def test_edge_rows(spark):
    rows = edge_rows()
    docs, bench = documents(spark, rows, extra=True), items(spark, [(1, ITEM)])
    assert decontaminate.find_copies(docs, bench).count() == 0
    kept = decontaminate.drop_copies(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_empty_tables(spark):
    assert decontaminate.find_copies(documents(spark, []), items(spark, [(1, ITEM)])).count() == 0
    assert decontaminate.find_copies(documents(spark, [(1, ITEM)]), items(spark, [])).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()
    exact = {
        (d["doc_id"], b["item_id"]) for d in docs for b in bench
        if decontaminate.normalise(b["text"]) in decontaminate.normalise(d["text"] or "")
    }
    got = op4_decontamination(spark, SF_SMALL).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0} == exact


def test_items_without_a_budget_are_whole_words_at_any_piece_length():
    item = decontaminate.normalise(ITEM)
    for chars in (decontaminate.PIECE_CHARS, len(item)):
        matcher = decontaminate.Matcher([(1, item)], chars)
        assert matcher.find(f"a {item} b")
        assert bool(matcher.find(f"a{item}b")) == (decontaminate.error_budget(len(item), chars) > 0)
