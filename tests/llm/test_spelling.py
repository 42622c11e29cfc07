from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from snapmart.llm import spelling
from snapmart.llm.queries import op13_spelling_variants
from tests.conftest import SF_SMALL
from tests.llm.brute import documents, edge_rows


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows, min_letters=6, min_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def restated(rows, min_letters=6, min_count=5):
    words = counted(rows, min_letters, min_count)
    forms, out = {}, {}
    for w, n in words.items():
        own = sorted(((-m, u) for u, m in words.items() if near(w, u)))
        form = own[0][1] if own and -own[0][0] >= 5 * n else None
        out[w] = [form, w, n, len(own), words.get(form)]
        forms[w] = form
    for w, row in out.items():
        while forms[row[1]]:
            row[1] = forms[row[1]]
    return {(w, *row) for w, row in out.items()}


def check(spark, rows, **parameters):
    got = list(map(tuple, spelling.group_variants(documents(spark, rows, extra=True), **parameters).collect()))
    assert len(got) == len(set(got)) and set(got) == restated(rows, **parameters)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words(spark, seed):
    """Few letters, so that words have many neighbours, runs of equal letters and ties."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.randint(3, 6))) for _ in range(150)] + ["abababababababab", "abababababababa", "bababababababab"]
    rows = [(rng.choice([None, *range(20)]), " ".join(rng.choices(words, weights=[1 + 3 ** rng.randint(0, 5) for _ in words], k=400))) for _ in range(30)]
    check(spark, rows, min_letters=3, min_count=2)


def test_chain_of_forms(spark):
    """Roots are followed over more than one hop."""
    counts = {"abcdefgh": 5, "abcdefghi": 26, "abcdefghij": 140, "abcdefghijk": 710, "abcdefghijkl": 3600, "zzzzzzzz": 9}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    check(spark, rows)


def test_edge_rows(spark):
    long = "X" * 5000 + "y" * 3000
    rows = edge_rows() * 5 + [(20 + i, long + " Àÿstraße-×÷abc KKelvin") for i in range(6)] + [(40, long[1:] + " ") for _ in range(5)]
    check(spark, rows)


def test_empty_table(spark):
    got = spelling.group_variants(documents(spark, []))
    assert got.count() == 0 and got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_node_numbers_are_those_of_a_trie():
    """Equal numbers if and only if equal prefixes, on both sides of LEVELS."""
    rng = random.Random(5)
    seen = {}
    for _ in range(400):
        letters = [rng.choice((1, 2, 90)) for _ in range(rng.randint(0, 14))]
        for depth, number in enumerate(spelling.nodes(letters)):
            assert -(1 << 63) <= number < 1 << 63
            assert seen.setdefault(number, letters[:depth]) == letters[:depth]
    assert len(seen) == len(set(map(tuple, seen.values())))


def test_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert set(map(tuple, op13_spelling_variants(spark, SF_SMALL).collect())) == restated(map(tuple, rows))
