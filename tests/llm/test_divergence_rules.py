from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from snapmart.llm import divergence_rules
from snapmart.llm.queries import op5_divergence_rules
from tests.llm.brute import documents, edge_rows, repeat_counts

SF = "/root/testdata/sf0.01"


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text("ab \n#|", max_size=120), max_size=6))
def test_counts(texts):
    if not texts:
        return
    made = divergence_rules._kernel(texts)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(made[n][i]) for n in names) for i in range(len(texts))] == [repeat_counts(t) for t in texts]


def test_distance():
    p, q = np.array([[1.0, 0.0], [2.0, 2.0], [0.0, 3.0], [0.0, 0.0]]), np.array([1.0, 1.0])
    got = divergence_rules.js_distance(p, q)
    want = np.sqrt(0.5 * (np.log2(1 / 0.75)) + 0.5 * (0.5 * np.log2(0.5 / 0.75) + 0.5 * np.log2(0.5 / 0.25)))
    assert np.allclose(got[:3], [want, 0, want])


def test_edge_rows(spark):
    rows = edge_rows()
    got = divergence_rules.judge(documents(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        texts = [t for i, t in rows if i == r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == repeat_counts(texts[0])
        assert not (r["base_failed"] and r["kept"])


def test_empty_table(spark):
    assert divergence_rules.judge(documents(spark, [])).count() == 0


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    quality = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    rows = op5_divergence_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = repeat_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    sound = [r for r in rows if not r["base_failed"] and quality.get(r["doc_id"]) == 1]
    assert sum(r["kept"] for r in sound) >= 0.99 * len(sound)
    junk = [r for r in rows if quality.get(r["doc_id"]) == 0]
    assert sum(r["kept"] for r in junk) <= 0.35 * len(junk)


def restated(rows):
    """id -> (language, class distance, word distance, kept), by loops over characters and words."""
    import re
    from math import log2, sqrt

    dr, limits = divergence_rules, divergence_rules.Limits()
    kinds = [(str.islower, 0), (str.isupper, 1), (str.isdigit, 2), (lambda c: c in "\t\n\x0b\x0c\r ", 3), (lambda c: c in ".,;:?'\"()-", 4),
             (lambda c: c == "!", 5), (lambda c: c in "#*$%&|<>", 6)]

    def measured(text):
        classes, common = [0] * 9, [0] * (len(dr.WORDS) + 1)
        for c in text:
            classes[8 if ord(c) > 127 else next((k for test, k in kinds if test(c)), 7)] += 1
        for word in re.findall(r"[^\x20\x09-\x0D]+", text):
            word = word.lower().strip(".,;:!?\"'()#*$%&")
            common[dr.WORDS.index(word) if word in dr.WORDS else -1] += 1
        n, _, _, _, repeats = repeat_counts(text)
        return classes, common, n < 20 or 100 * repeats > 30 * n

    def distance(p, q):
        p, q = ([x / sum(h) for x in h] if sum(h) else h for h in (p, q))
        return sqrt(max(sum(a * log2(2 * a / (a + b)) / 2 for a, b in ((x, y) for u, v in ((p, q), (q, p)) for x, y in zip(u, v)) if a), 0))

    def mean(rows):
        table = {}
        for classes, common, failed in rows:
            hits = {lang: sum(common[dr.WORDS.index(w)] for w in words) for lang, words in dr.COMMON_WORDS.items()}
            best = max(hits.values())
            if not failed and best:
                lang = next(name for name, n in hits.items() if n == best)
                table.setdefault(lang, []).append([x / max(sum(classes), 1) for x in classes] + [x / max(sum(common), 1) for x in common])
        return {lang: [sum(c) / len(v) for c in zip(*v)] for lang, v in table.items()}

    def verdict(row, table):
        classes, common, failed = row
        chars, words = sum(classes), sum(common)
        foreign = classes[8] > classes[0] + classes[1]
        unknown = foreign or words - common[-1] < limits.known_share * words
        found = []
        for lang in sorted(table):
            by_class, by_word = distance(classes, table[lang][:9]), distance(common, table[lang][9:])
            ok = foreign or chars < limits.class_chars or by_class <= limits.class_distance + limits.class_slack / chars
            ok = ok and (unknown or words < limits.word_words or by_word <= limits.word_distance + limits.word_slack / words)
            found.append((by_class + by_word - 4 * ok, lang, by_class, by_word, ok))
        _, lang, by_class, by_word, ok = min(found, key=lambda f: f[0])
        return None if unknown else lang, by_class, by_word, ok

    known = {i: measured(t or "") for i, t in rows}
    table = mean(known.values())
    table = mean(row for row in known.values() if verdict(row, table)[3])
    return {i: (*(v := verdict(row, table))[:3], not row[2] and v[3]) for i, row in known.items()}


RUSSIAN = "Сегодня утром мы вышли из дома и пошли через старый парк к реке, где уже собрались люди. " * 4
POLISH = "Dzisiaj rano wyszliśmy przed dom, żeby zobaczyć jak wschodzi słońce nad rzeką oraz jak mgła znika znad łąk. "


def test_verdicts_against_loops(spark):
    """Every distance, language and verdict on whole given texts and a few more."""
    rows = list(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    rows += [(-1, RUSSIAN), (-2, POLISH * 3), (-3, "###### !!!! $$$ " * 40), (-4, ""), (-5, "日本語の文章です。" * 30)]
    want = restated(rows)
    got = {r["doc_id"]: r for r in divergence_rules.judge(documents(spark, rows)).collect()}
    for i, (language, by_class, by_word, kept) in want.items():
        r = got[i]
        assert (r["language"], r["kept"]) == (language, kept), i
        assert abs(r["class_distance"] - by_class) < 1e-6 and abs(r["word_distance"] - by_word) < 1e-6


def test_a_language_without_a_reference_is_kept(spark):
    """Sound texts in another script, or in Latin script without a common word of the four, are no junk."""
    rows = list(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    russian = " ".join(f"слово{chr(0x430 + i % 32)}{chr(0x430 + i // 32)} далеко" for i in range(60)) + "."
    polish = " ".join(f"rzeka{chr(97 + i % 26)} płynie{chr(97 + i // 26)} daleko," for i in range(40))
    got = {r["doc_id"]: r for r in divergence_rules.judge(documents(spark, [*rows, (-1, russian), (-2, polish)])).collect()}
    for i in (-1, -2):
        assert not got[i]["base_failed"] and got[i]["kept"] and got[i]["language"] is None
