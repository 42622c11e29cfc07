from __future__ import annotations

import zlib

from snapmart.llm import toxicity
from snapmart.llm.queries import op8_toxicity
from tests.llm.brute import documents, edge_rows

SF = "/root/testdata/sf0.1"
SEED = toxicity.Lexicon({f" {w} ": 3.0 for w in toxicity.SEED_WORDS}, key="test")


def measure(text, lexicon=SEED):
    return toxicity.Matcher(lexicon).measure(toxicity.fold(text))


def test_folding():
    assert toxicity.fold("1d10t, M0R0N! 5tupid") == " idiot moron stupid "
    assert toxicity.fold("іdіоt ｓｃｕｍ") == " idiot scum "
    assert toxicity.fold("in 2024 for 10 a$$$") == " in 2024 for 10 a "
    assert toxicity.fold("") == "  "


def test_whole_words_beginnings_and_the_heaviest():
    lexicon = toxicity.Lexicon({" scum ": 3.0, " scu": 2.0, " scumb": 5.0}, key="x")
    assert measure("scum", lexicon) == (3.0, 3.0, 1)
    assert measure("scumbag scuttle discuss", lexicon) == (7.0, 5.0, 2)


def test_exception_phrases():
    assert measure("the trash can") == (0.0, 0.0, 0)
    assert measure("such trash, and a trash can")[2] == 1


def test_longer_texts_are_scored_lower():
    texts = ["you idiot", "you idiot " + "and then some plain words " * 100]
    x, hits = toxicity.inputs(toxicity.Matcher(SEED), texts)
    assert hits == [1, 1] and x[0, 0] > x[1, 0]


def test_edge_rows(spark):
    rows = edge_rows()
    got = toxicity.score(documents(spark, rows, extra=True), SEED).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] < 0.5 for r in got)
    assert toxicity.score(documents(spark, []), SEED).count() == 0


def test_without_labels_the_seed_words_serve(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(documents(spark, edge_rows()), labels)
    assert set(lexicon.weights) == {f" {w} " for w in toxicity.SEED_WORDS}
    scored = toxicity.score(documents(spark, [(1, "you stupid pathetic moron"), (2, "a kind word")]), lexicon)
    assert {r["doc_id"]: r["score"] >= 0.5 for r in scored.collect()} == {1: True, 2: False}


def test_held_out_accuracy(spark):
    toxic = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    rows = op8_toxicity(spark, SF).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [(toxic[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    found = [b for a, b in held if a == 1]
    assert sum(found) >= 0.9 * len(found)


def restated(text, lexicon):
    """Score by loops: every word of the folded text, its heaviest entry, whether an exception phrase holds it."""
    import math

    words = toxicity.fold(text).split()
    phrases = [toxicity.fold(p).split() for p in lexicon.exceptions]
    spared = {at + i for at in range(len(words)) for p in phrases if words[at : at + len(p)] == p for i in range(len(p))}
    weights = []
    for at, word in enumerate(words):
        own = [w for entry, w in lexicon.weights.items() if (entry == f" {word} " if entry.endswith(" ") else word.startswith(entry[1:]))]
        if own and at not in spared:
            weights.append(max(own))
    total = min(sum(weights) * toxicity.SPREAD / (max(len(words), 1) + 20), toxicity.LIMIT)
    a, b, c = lexicon.curve
    return 1 / (1 + math.exp(-(a + b * total + c * max(weights, default=0)))), len(weights)


def test_scores_against_loops(spark):
    import random

    draw = random.Random(9)
    lexicon = toxicity.Lexicon({" idiot ": 3.0, " trash ": 2.0, " idio": 1.0, " clow": 2.5, " can idiot": 4.0, " loser ": 1.5}, key="loops")
    pieces = ["idiot", "IDI0T", "idiotic", "trash", "trash can", "class clown", "clown", "can", "and", "l0ser", "fish", "clown fish.", "\u0456diot"]
    rows = [(i, " ".join(draw.choice(pieces) for _ in range(draw.choice([0, 1, 5, 40, 300])))) for i in range(60)] + [(99, None)]
    lexicon = toxicity.Lexicon({k: v for k, v in lexicon.weights.items() if " " not in k.strip()}, key="loops")
    got = {r["doc_id"]: r for r in toxicity.score(documents(spark, rows), lexicon).collect()}
    for i, text in rows:
        score, hits = restated(text or "", lexicon)
        assert got[i]["n_matches"] == hits and abs(got[i]["score"] - score) < 1e-9, (i, text)


def test_many_exceptions_in_one_text():
    import time

    matcher = toxicity.Matcher(toxicity.Lexicon({f" {w} ": 3.0 for w in toxicity.SEED_WORDS}))
    begin = time.time()
    assert matcher.measure(toxicity.fold("trash can idiot " * 60_000))[2] == 60_000
    assert time.time() - begin < 20
