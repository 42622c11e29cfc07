from __future__ import annotations

import itertools
import zlib

import numpy as np

from snapmart.llm import line_crf
from snapmart.llm.queries import op6_line_crf
from tests.llm.brute import documents, edge_rows

SF = "/root/testdata/sf0.1"
GOOD = ["A plain line of words.\nAnd another one, quite like it.\nA third follows here."] * 5
BAD = ["###$$$ %%% &&&*** $$$\n|||| ### %%% $$$ <<<>>>\n*** ### *** ###"] * 5


def test_marginals_by_enumeration():
    draw = np.random.default_rng(3)
    lines_of = np.array([3, 1, 4])
    emission, chain = draw.normal(size=8), draw.normal(size=(2, 2))
    good, changes, total = line_crf.marginals(emission, chain, lines_of)
    want, want_changes, want_total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lines_of:
        paths = list(itertools.product((0, 1), repeat=n))
        score = [np.exp(sum(emission[at + i] for i in range(n) if p[i]) + sum(chain[a, b] for a, b in zip(p, p[1:]))) for p in paths]
        z = sum(score)
        want += [sum(s for s, p in zip(score, paths) if p[i]) / z for i in range(n)]
        for s, p in zip(score, paths):
            for a, b in zip(p, p[1:]):
                want_changes[a, b] += s / z
        want_total += np.log(z)
        at += n
    assert np.allclose(good, want) and np.allclose(changes, want_changes) and np.isclose(total, want_total)


def test_features_do_not_depend_on_the_batch():
    texts = ["one one two\n\nÉté !!! 12", "", "  \n x", "last"]
    together = line_crf.line_features(texts)
    alone = [line_crf.line_features([t]) for t in texts]
    assert np.allclose(together[0], np.concatenate([a[0] for a in alone]))
    assert together[2].tolist() == [t.count("\n") + 1 for t in texts]


def fitted():
    own, _, lines_of = line_crf.line_features(GOOD + BAD)
    return line_crf.fit(own, lines_of, [1] * 5 + [0] * 5)


def test_good_and_bad_lines():
    field = fitted()
    score, lines, bad = line_crf.score_texts([GOOD[0], BAD[0], GOOD[0] + "\n" + BAD[0]], field)
    assert score[0] > 0.9 and score[1] < 0.1 and 0.1 < score[2] < 0.9
    assert lines == [3, 3, 6] and bad == [0, 3, 3]


def test_one_class_gives_no_field(spark):
    own, _, lines_of = line_crf.line_features(GOOD)
    assert line_crf.fit(own, lines_of, [1] * 5) is None
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, edge_rows())
    assert line_crf.train(docs, labels) is None
    assert {r["score"] for r in line_crf.score(docs, None).collect()} == {1.0}


def test_edge_rows(spark):
    rows, field = edge_rows(), fitted()
    docs = documents(spark, rows, extra=True)
    got = line_crf.score(docs, field).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    kept = line_crf.keep_good(docs, field)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["score"] >= line_crf.GOOD for r in got)
    assert line_crf.score(documents(spark, []), field).count() == 0


def test_held_out_accuracy(spark):
    quality = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    rows = op6_line_crf(spark, SF).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.7)
    held = [(quality[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and quality.get(r["doc_id"]) is not None]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)


def test_long_chains_equal_the_batch():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 4, 5, 16, 17, 50, 101, 1000):
        emission, chain = rng.normal(size=n) * 4, rng.normal(size=(2, 2)) * 2
        want, _, _ = line_crf.marginals(emission, chain, np.array([n]))
        assert np.allclose(line_crf.long_marginals(emission, chain), want, atol=1e-9)


def test_long_texts_are_scored_in_blocks(monkeypatch):
    """Whatever the sizes of blocks and groups, the scores are those of the whole text at once."""
    rng = np.random.default_rng(5)
    field = line_crf.Field(np.zeros(15), np.ones(15), rng.normal(size=48) * 0.3, rng.normal(size=(2, 2)))
    texts = ["x\n" * 60, "a b\nfoo! bar\n\n12 é\n" * 20, "", "one line", "y" * 300 + "\nz", "\n" * 33, "word word\n" * 25]
    own, size, lines_of = line_crf.line_features(texts)
    good, _, _ = line_crf.marginals(field.inputs(own, lines_of) @ field.weights, field.chain, lines_of)
    owner = np.repeat(np.arange(len(texts)), lines_of)
    want = [np.average(good[owner == i], weights=size[owner == i] + 1e-6) for i in range(len(texts))]
    for long, lines, chars in ((2000, 20_000, 1 << 20), (10, 7, 1 << 20), (0, 3, 40), (2000, 30, 100)):
        monkeypatch.setattr(line_crf, "LONG_LINES", long)
        monkeypatch.setattr(line_crf, "BLOCK_LINES", lines)
        monkeypatch.setattr(line_crf, "BLOCK_BYTES", chars)
        got = line_crf.score_texts(texts, field)
        assert np.allclose(got[0], want, atol=1e-6) and got[1] == lines_of.tolist()


def test_a_text_of_many_short_lines_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(6)
    field = line_crf.Field(np.zeros(15), np.ones(15), rng.normal(size=48) * 0.3, rng.normal(size=(2, 2)))
    text = "x\n" * 2_000_000
    tracemalloc.start()
    _, lines, _ = line_crf.score_texts([text], field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lines == [2_000_001] and peak < 200 << 20


def test_stretch_of_a_long_text():
    text = "\n".join(map(str, range(1000)))
    part = line_crf.stretch(text, 50).split("\n")
    assert len(part) == 50 and [int(x) for x in part] == list(range(int(part[0]), int(part[0]) + 50))
    assert line_crf.stretch("a\nb", 50) == "a\nb"
