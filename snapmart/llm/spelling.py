"""Spelling variants of the corpus's own words, by pairs of trie nodes.

Take two tries over the words: one of the words, one of the words reversed. A prefix is a node of the
first, a suffix a node of the second. Skipping the letter at position i leaves the pair (node of the i
letters before, node of the letters after); inserting one at i splits the word into (node of
the first i letters, node of the rest). Two words differ by one replaced letter if and only if they share a
skipping pair, and by one inserted or deleted letter if and only if a skipping pair of the longer one is an inserting
pair of the shorter one. So an equi-join on two integers finds all neighbours, and nothing else.

Nodes are numbered by rule rather than by a table: the first LEVELS levels as in a complete trie (a
child's number is BASE times its parent's plus its letter), deeper ones, as negative numbers, by a polynomial modulo a prime.
The join's results are compared letter by letter, so a rare false meeting of deep nodes has no effect.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import stage, text_slices

# The letters of a word, the share of runs that lose a letter, the least length and count, the ratio of counts.
FIRST, LAST = "\u00C0", "\u00FF"
DIVISOR = 199
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5

#: Letters are numbered from 1, a to z first.
BASE = 26 + ord(LAST) - ord(FIRST) + 2
#: BASE ** LEVELS is below 2 ** 63.
LEVELS = 9
PRIME, FACTOR = (1 << 61) - 1, 0x1F35_9D2B_6C47_A8E3 % ((1 << 61) - 1)

#: Words that a task counts before it passes its counts on.
MAX_HELD = 500_000

INSERT, SKIP, SKIP_LAST = 0, 1, 2


def _tally(counts: Counter, doc_id: object, text: str, runs: re.Pattern, least: int) -> None:
    start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    for run, n in Counter(runs.findall(text)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DIVISOR == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        counts[run] += n


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts with at least ``min_letters`` letters and ``min_count`` occurrences.

    Runs of letters are lower-cased (A-Z only); a run whose stated checksum with the id is divisible by
    DIVISOR loses a letter. A null id counts as empty text in the checksum. Counts are summed in the task first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[a-z{FIRST}-{LAST}]{{{min_letters},}}")
        counts: Counter = Counter()

        def made() -> Iterator[pa.RecordBatch]:
            words = list(counts.items())
            counts.clear()
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], names=["word", "n"])

        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), texts):
                    _tally(counts, doc_id, text.encode().lower().decode(), runs, min_letters)  # lower() of bytes: A-Z only
                    if len(counts) > MAX_HELD:
                        yield from made()
        yield from made()

    counted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def nodes(letters: list[int]) -> list[int]:
    """Numbers of the trie nodes from the root down along ``letters``."""
    out, number, deep = [0], 0, 0
    for depth, letter in enumerate(letters):
        deep = (deep * FACTOR + letter) % PRIME
        if depth < LEVELS:
            number = number * BASE + letter
            out.append(number)
        else:
            out.append(-1 - deep)
    return out


def node_pairs(word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix node, suffix node, kind) of all inserting and skipping pairs of a word.

    Deleting any letter of a run of equal ones gives the same word; the pair of the run's last letter has
    kind SKIP_LAST, and only that one is matched with shorter words.
    """
    letters = [ord(c) - ord("a") + 1 if c <= "z" else ord(c) - ord(FIRST) + 27 for c in word]
    size = len(letters)
    before = np.array(nodes(letters), dtype=np.int64)
    after = np.array(nodes(letters[::-1]), dtype=np.int64)[::-1]
    own = np.array(letters)
    kinds = np.full(size, SKIP)
    kinds[np.append(own[1:] != own[:-1], True)] = SKIP_LAST
    return (
        np.concatenate((before, before[:size])), np.concatenate((after, after[1:])),
        np.concatenate((np.full(size + 1, INSERT), kinds)))


def _pairs(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for word_id, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before, after, kinds = node_pairs(word)
                held.append((before, after, kinds.astype(np.int8), np.full(len(kinds), word_id)))
                size += len(kinds)
                if size > 200_000:
                    yield made(held)
                    held, size = [], 0
            if held:
                yield made(held)

    def made(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["prefix", "suffix", "kind", "word_id"])

    return words.select("word_id", "word").mapInArrow(run, "prefix long, suffix long, kind byte, word_id long")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): a row for each ordered pair of words that differ by one letter.

    ``words`` has (word_id, word, n) with distinct words. No pair of nodes has more entries than the
    alphabet has letters, so the join's rows grow with the neighbours that there are. Links are made distinct and compared exactly.
    """
    pairs = stage(_pairs(words), "node-pairs")
    skips, all_pairs = pairs.where(F.col("kind") != INSERT).alias("a"), pairs.alias("b")
    meets = (
        (F.col("a.prefix") == F.col("b.prefix")) & (F.col("a.suffix") == F.col("b.suffix"))
        & (((F.col("b.kind") == INSERT) & (F.col("a.kind") == SKIP_LAST))
           | ((F.col("b.kind") != INSERT) & (F.col("a.word_id") < F.col("b.word_id")))))
    links = skips.join(all_pairs, meets).select(F.col("a.word_id").alias("x"), F.col("b.word_id").alias("y")).distinct()
    one = words.select(F.col("word_id").alias("x"), F.col("word").alias("word"), F.col("n").alias("n"))
    two = words.select(F.col("word_id").alias("y"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    links = stage(
        links.join(one, "x").join(two, "y").where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n"), "near-words")
    return links.unionAll(links.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): each step doubles the hops taken; a form is RATIO times as frequent, so few are needed."""
    hops = stage(forms, "forms")
    while True:
        ahead = hops.select(F.col("word").alias("next"), F.col("form").alias("beyond"))
        joined = hops.join(ahead, hops["form"] == ahead["next"], "left")
        taken = stage(joined.select("word", F.coalesce("beyond", "form").alias("form"), F.col("beyond").isNotNull().alias("moved")), "forms")
        hops = taken.select("word", "form")
        if taken.where("moved").isEmpty():
            return hops.select("word", F.col("form").alias("root"))


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``count_words``.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced letter. ``form`` is the most
    frequent of them (ties: smallest in code-point order) if it is at least ``ratio`` times as frequent as the
    word, else null; ``root`` is reached from the word over forms, or the word itself.

    Null texts have no words, an empty table gives an empty result, repeated rows count each, extra columns are
    ignored. Words of any length cost in proportion to their letters.
    """
    words = stage(
        count_words(docs, id_col, text_col, min_letters, min_count).withColumn("word_id", F.monotonically_increasing_id()), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("near"))).alias("best"))
    largest = -F.col("best.less")
    taken = F.coalesce(largest >= ratio * F.col("n"), F.lit(False))
    known = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, largest).alias("form_n")), "variants")
    roots = _roots(known.where("form is not null").select("word", "form"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
