"""Quality rules by distribution divergence, beside counts of repeats and symbols.

A document has two histograms: of its characters over a few classes, and of its
words over the common words of some languages. The mean histograms of all
documents written in a language are that language's references; a document is
kept if it is close to those of at least one language, by Jensen-Shannon distance.
Short texts have ragged histograms, so each test has a least length, below which
it passes, and an allowance that shrinks with the length.

A text may be in a language without a reference. One with more letters beyond
ASCII than in it is in another script: no histogram applies to it, and it passes both
tests. One in Latin script that holds hardly any common word of the four languages passes the test
of words, and is held to the character classes alone. A language that shares many of those words (Italian, say) is
judged by the closest reference.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import byte_classes, map_texts, stage

#: Common words by language; fixed values.
COMMON_WORDS = {
    "en": "the of and to in is that for it as with was on by this be are from at or an a not have".split(),
    "fr": "de la le et les des en un une du dans que qui est pour par sur au avec pas plus ce il".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo es como más".split(),
}
LANGUAGES = tuple(COMMON_WORDS)
WORDS = tuple(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))

#: Windows of words whose repeats are counted.
WINDOW = 8
_CLASSES = 9  # lower, upper, digit, blank, stop, exclamation, symbol, other, not ASCII; then the rest of a code point


_TABLE = byte_classes()
_PLACE = {w.encode(): i for i, w in enumerate(WORDS)}


@dataclass(frozen=True)
class Limits:
    """Largest distances and least lengths; ``slack`` / length is added to a distance's limit."""

    class_distance: float = 0.14
    class_chars: int = 80
    class_slack: float = 40.0
    word_distance: float = 0.30
    word_words: int = 60
    word_slack: float = 14.0
    known_share: float = 0.02  # common words per word from which a language counts as one of the four


def _fold(codes: np.ndarray, step: int) -> np.ndarray:
    """Codes of pairs of codes ``step`` apart, equal for equal pairs only."""
    pairs = codes[:-step] * (int(codes.max()) + 1) + codes[step:]
    return pd.factorize(pairs)[0].astype(np.int64)


def repeated_words(codes: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """For each document, the words in windows that it holds twice or more."""
    out = np.zeros(docs, dtype=np.int64)
    if len(codes) < WINDOW:
        return out
    window, width = codes, 1
    while width < WINDOW:  # windows of 2, 4 and 8 words
        window = _fold(window, width)
        width *= 2
    inside = owner[: len(window)] == owner[WINDOW - 1 :]
    if not inside.any():
        return out
    at = np.flatnonzero(inside)
    keys = pd.factorize(owner[at].astype(np.int64) * (int(window.max()) + 1) + window[at])[0]
    twice = at[np.bincount(keys)[keys] >= 2]
    edges = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=docs)


def _kernel(texts: list[str]) -> dict[str, list]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raw]  # at the six ASCII blanks
    n_words = np.array([len(w) for w in split], dtype=np.int64)
    owner = np.repeat(np.arange(len(raw)), n_words)
    flat = np.empty(len(owner), dtype=object)
    flat[:] = [w for words in split for w in words]
    codes, distinct = pd.factorize(flat)
    known = np.array([_PLACE.get(w.decode("utf-8", "replace").lower().strip(".,;:!?\"'()#*$%&").encode(), len(WORDS)) for w in distinct], dtype=np.int64)
    bins = len(WORDS) + 1
    common = np.bincount(owner * bins + known[codes], minlength=len(raw) * bins).reshape(-1, bins) if len(owner) else np.zeros((len(raw), bins), dtype=np.int64)
    classes = np.array([np.bincount(_TABLE[np.frombuffer(r, dtype=np.uint8)], minlength=_CLASSES + 1) for r in raw]).reshape(len(raw), -1)
    dup = []
    for r in raw:
        lines = [line for line in r.split(b"\n") if line.strip()]
        dup.append(len(lines) - len(set(lines)))
    return {
        "n_words": n_words,
        "word_chars": classes[:, :9].sum(axis=1) - classes[:, 3],
        "n_symbols": classes[:, 6],
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(codes.astype(np.int64), owner, len(raw)),
        "classes": list(classes[:, :_CLASSES]),
        "common": list(common),
    }


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root, base 2) of rows of ``p`` to ``q``; rows are normalised.

    An empty histogram is at distance 1 from any other.
    """
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1e-300)
    q = q / np.maximum(q.sum(axis=-1, keepdims=True), 1e-300)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=-1)
        b = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """language -> mean class and common-word histograms of the documents written in it.

    A document's language is the one whose common words it holds most of. All
    documents that pass the base rules count, each the same. The result has a
    few numbers per language.
    """
    hits = [sum((F.col("common")[WORDS.index(w)] for w in COMMON_WORDS[lang]), F.lit(0)).cast("long") for lang in LANGUAGES]
    best = F.greatest(*hits)
    lang = F.coalesce(*[F.when(h == best, F.lit(name)) for name, h in zip(LANGUAGES, hits)])
    sound = measured.where(~F.col("base_failed") & (best > 0)).select(
        lang.alias("lang"), F.concat(
            F.transform("classes", lambda c: c / F.greatest(F.col("n_chars"), F.lit(1))),
            F.transform("common", lambda c: c / F.greatest(F.col("n_words"), F.lit(1))),
        ).alias("shares"))
    rows = (
        sound.select("lang", F.posexplode("shares").alias("at", "share"))
        .groupBy("lang", "at").agg(F.avg("share").alias("share")).collect()
    )
    table: dict[str, list[float]] = {}
    for row in rows:
        table.setdefault(row["lang"], [0.0] * (_CLASSES + len(WORDS) + 1))[row["at"]] = row["share"]
    return {lang: (v[:_CLASSES], v[_CLASSES:]) for lang, v in table.items()}


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and histograms of each row's text, with ``base_failed``."""
    counted = map_texts(
        docs.select(id_col, F.col(text_col).alias("text")), _kernel,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<int>, common array<int>",
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "n_chars", F.aggregate("classes", F.lit(0).cast("long"), lambda acc, c: acc + c))


def _verdicts(measured: DataFrame, table: dict[str, tuple[list[float], list[float]]], limits: Limits) -> DataFrame:
    """``measured`` with language, class_distance, word_distance and near (to at least one reference)."""
    names = sorted(table)

    def compare(classes: pd.Series, common: pd.Series) -> pd.DataFrame:
        c, w = (np.array(x.tolist(), dtype=float).reshape(len(x), -1) for x in (classes, common))
        if not names or not len(c):
            none = [None] * len(c)
            return pd.DataFrame({"language": none, "class_distance": none, "word_distance": none, "near": [True] * len(c)})
        by_class = np.array([js_distance(c, np.array(table[n][0])) for n in names])
        by_word = np.array([js_distance(w, np.array(table[n][1])) for n in names])
        chars, words = c.sum(axis=1), w.sum(axis=1)
        class_limit = np.where(chars >= limits.class_chars, limits.class_distance + limits.class_slack / np.maximum(chars, 1), 2)
        word_limit = np.where(words >= limits.word_words, limits.word_distance + limits.word_slack / np.maximum(words, 1), 2)
        foreign = c[:, 8] > c[:, 0] + c[:, 1]
        unknown = foreign | (words - w[:, -1] < limits.known_share * words)
        ok = ((by_class <= class_limit) | foreign) & ((by_word <= word_limit) | unknown)
        best, row = np.argmin(by_class + by_word - 4 * ok, axis=0), np.arange(len(c))
        return pd.DataFrame({
            "language": np.where(unknown, None, np.array(names, dtype=object)[best]), "class_distance": by_class[best, row],
            "word_distance": by_word[best, row], "near": ok[best, row],
        })

    verdict = F.pandas_udf(compare, "language string, class_distance double, word_distance double, near boolean")
    return measured.withColumn("verdict", verdict("classes", "common")).select("*", "verdict.*").drop("verdict")


def judge(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the counts, the distances and ``kept``.

    Columns: n_words, word_chars (code points in words), n_symbols, n_dup_lines,
    n_repeat_words, base_failed, ``language`` (the closest, null where none of the four applies), class_distance,
    word_distance, kept. A null text counts as empty: no words, so the base rules
    fail it. Where no document at all passes the base rules there are no
    references, and the distances are null. Repeated rows keep a row each; extra
    columns are ignored.

    Measures once, into a staged table. The references are worked out twice: from
    all sound documents, and again from those near the first ones, so that
    junk hardly moves them. Only they reach the driver.
    """
    measured = stage(measure(docs, id_col, text_col), "divergence")
    first = references(measured)
    table = references(_verdicts(measured, first, limits).where("near").select(measured.columns)) if first else first
    judged = _verdicts(measured, table, limits)
    return judged.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "language", "class_distance", "word_distance", (~F.col("base_failed") & F.col("near")).alias("kept"))
