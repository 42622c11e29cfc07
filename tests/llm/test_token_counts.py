from __future__ import annotations

import functools
import math
import random
import time

import public_tokenizers
import regex
from pyspark.sql import functions as F

from snapmart.llm import token_counts
from snapmart.llm.queries import COUNT_VOCABULARY, op1_token_counts
from tests.conftest import SF_SMALL
from tests.llm.brute import documents, edge_rows

PATH = public_tokenizers.path(COUNT_VOCABULARY)
SCORES = token_counts.zipf_scores(PATH)
LONGEST = max(map(len, SCORES))


@functools.cache
def best_segmentation(word: str) -> int:
    raw = word.encode("utf-8", "surrogatepass")
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(raw)
    for end in range(1, len(raw) + 1):
        for begin in range(max(0, end - LONGEST), end):
            score = SCORES.get(raw[begin:end])
            if score is not None and best[begin][0] + score > best[end][0]:
                best[end] = best[begin][0] + score, best[begin][1] + 1
    return best[-1][1]


def expected(text: str | None) -> tuple[int, int, int]:
    parts = regex.findall(public_tokenizers.PATTERN, text or "")
    return sum(map(best_segmentation, parts)), len(parts), len((text or "").encode())


def test_scores_are_a_distribution():
    assert abs(sum(math.exp(s) for s in SCORES.values()) - 1) < 1e-9
    assert all(bytes([b]) in SCORES for b in range(256))


def test_trie_counts_as_each_word_by_itself():
    words = {"the", "there", "therefore", "thereforé", "", "a" * 300, " 日本語", "x" * 64, "xx\U0001f600"}
    trie = token_counts.PrefixTrie(SCORES)
    trie.insert(words)
    assert {w: trie.counts([w]) for w in words} == {w: best_segmentation(w) for w in words}


def test_prefixes_are_scored_once():
    trie = token_counts.PrefixTrie(SCORES)
    trie.insert({"therefore"})
    before = trie.nodes
    trie.insert({"there", "the"})
    assert trie.nodes == before


def test_a_full_trie_begins_anew():
    trie = token_counts.PrefixTrie(SCORES, max_nodes=5)
    for word in ("alpha", "beta", "gamma"):
        trie.insert({word})
        assert trie.counts([word]) == best_segmentation(word)


def test_one_slice_may_fill_the_trie_many_times(monkeypatch):
    words = {f"{a}{b}{c}" for a in ("alpha", "日本", "x" * 70) for b in ("beta", "ภาษา") for c in "abcdefgh"}
    for kept in (0, 1000, token_counts.MAX_KEPT):
        trie = token_counts.PrefixTrie(SCORES, max_nodes=5, max_kept=kept)
        assert trie.insert(words) == {w: best_segmentation(w) for w in words}
        assert trie.counts([*words, *words]) == 2 * sum(map(best_segmentation, words))
        assert trie.nodes <= 6 + token_counts.MAX_SHARED
    monkeypatch.setattr(token_counts, "_trie", lambda path: token_counts.PrefixTrie(SCORES, max_nodes=5, max_kept=0))
    texts = [" ".join(sorted(words)), "日本語" * 40 + " alpha beta", ""]
    got = token_counts._kernel(texts, PATH, public_tokenizers.PATTERN)
    assert list(zip(got["n_tokens"], got["n_pretokens"])) == [expected(t)[:2] for t in texts]


def test_a_long_unbroken_run_tries_only_lengths_that_occur():
    rng = random.Random(5)
    text = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(333_000))  # 1 MB
    trie = token_counts.PrefixTrie(SCORES)
    begun = time.process_time()
    trie.counts([text])
    assert time.process_time() - begun < 20
    for run in (text[:3000], " " * 500, "abc" * 200 + text[:50], "a", "ab", "é"):
        assert trie.counts([run]) == best_segmentation(run)


def test_matches_the_unigram_model_of_a_library():
    """The best total score, found by another implementation over single characters."""
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    vocabulary = [(p.decode(), s) for p, s in SCORES.items() if p.isascii() and p.decode().isprintable() and b" " not in p]
    other = Tokenizer(Unigram(vocabulary, unk_id=0, byte_fallback=False))
    for word in ("internationalisation", "counting", "qzxv", "therefore", "2024"):
        total = sum(SCORES[t.encode()] for t in other.encode(word).tokens)
        trie = token_counts.PrefixTrie(SCORES)
        trie.insert({word})
        assert abs(trie._best[-1] - total) < 1e-9


def test_edge_rows(spark):
    rows = edge_rows()
    got = token_counts.count_tokens(documents(spark, rows, extra=True), PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["n_pretokens"], r["n_bytes"]) for r in got) == sorted(
        (i or -1, *expected(t)) for i, t in rows)


def test_empty_table(spark):
    assert token_counts.count_tokens(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.col("text")).collect())
    got = {r["doc_id"]: (r["n_tokens"], r["n_pretokens"], r["n_bytes"]) for r in op1_token_counts(spark, SF_SMALL).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}
