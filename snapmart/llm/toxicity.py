"""Toxicity by a weighted lexicon, matched with an Aho-Corasick machine.

Texts are folded first: lower case, compatibility forms, letters of other scripts
that look Latin, and digits or signs that stand for letters inside a word. The
lexicon holds whole words and beginnings of words with weights; of all entries that
match a word the heaviest counts. Words inside an exception phrase don't count. The
sum of weights is normalised by the length of the text, and a logistic curve over
it and the heaviest match gives the score.

Weights are log odds ratios of a term's document frequencies among labelled toxic
and other documents, less their uncertainty. Terms are learnt from one half of a bounded sample, and the curve
from the other, so that chance finds are weighed as such.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import id_crc, labelled_sample, map_texts, stage, text_slices

#: Labelled documents of each class that weights are learnt from.
SAMPLE_DOCS = 6_000
#: The toxic documents of the sample that an entry of a learnt lexicon must occur in.
MIN_TOXIC = 3
#: Beginnings of words that can be entries.
PREFIXES = (4, 5, 6, 7, 8)
#: Least weight of an entry, and the standard errors that a log odds ratio is lowered by.
MIN_WEIGHT = 1.5
CONFIDENCE = 1.645

#: Words that are always in the lexicon, with this weight unless a higher one is learnt.
SEED_WORDS = ("idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting", "trash", "clown")
SEED_WEIGHT = 3.0
#: Phrases in which a word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "white trash bag", "class clown", "clown fish", "pathetic fallacy", "sore loser rule")

#: Letters of other scripts that look like Latin ones; fixed values.
HOMOGLYPHS = dict(zip(
    "аеорсухіјѕԁһԛѡвкмнтαβεικνορτυχγ",
    "aeopcyxijsdhqwbkmhtabeiknoptuxy",
))
#: Digits and signs that stand for letters; fixed values.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_SUBSTITUTE = re.compile(r"(?<![0-9@$])[013457@$]{1,2}(?=[^\W\d_])|(?<=[^\W\d_])[013457@$]{1,2}(?=[^\W\d_])")
_TABLE = str.maketrans(HOMOGLYPHS)
_OTHERS = re.compile(r"[^\w]+|_+")
_LATIN = re.compile("[\x00-ſ]*")


def fold(text: str) -> str:
    """Folded words with single spaces, and a space at both ends."""
    low = text.lower()
    if not _LATIN.fullmatch(low):
        low = unicodedata.normalize("NFKC", low).lower().translate(_TABLE)
    low = _SUBSTITUTE.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), low)
    return f" {_OTHERS.sub(' ', low).strip()} "


@dataclass(frozen=True)
class Lexicon:
    """Weights by entry (a word with a space at both ends, or a beginning with one before it) and the curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.5)
    key: str = field(default="")


#: The curve's inputs: the sum of weights per SPREAD words, and the heaviest weight. Sums over LIMIT count as LIMIT: more
#: toxic words don't make such a text more toxic, and a few extreme texts don't set the curve's slope.
SPREAD, LIMIT = 100.0, 12.0


class Matcher:
    """Sums the weights of a folded text's words."""

    def __init__(self, lexicon: Lexicon) -> None:
        self._machine = ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self._machine.add_word(entry, (entry, weight))
        for phrase in lexicon.exceptions:
            entry = fold(phrase)
            self._machine.add_word(entry, (entry, -1.0))
        self._none = not len(self._machine)
        if not self._none:
            self._machine.make_automaton()

    def measure(self, folded: str) -> tuple[float, float, int]:
        """(sum of the words' weights, heaviest weight, words matched)."""
        if self._none:
            return 0.0, 0.0, 0
        words: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for last, (entry, weight) in self._machine.iter(folded):
            begin = last + 1 - len(entry)
            if weight < 0:
                spared.append((begin, last))
            elif weight > words.get(begin, 0.0):
                words[begin] = weight
        if spared:
            # both in order of their place: a word is spared if a phrase that begins before it reaches it
            spared.sort()
            kept, nth, reach = {}, 0, -1
            for at in sorted(words):
                while nth < len(spared) and spared[nth][0] <= at:
                    reach = max(reach, spared[nth][1])
                    nth += 1
                if at >= reach:
                    kept[at] = words[at]
            words = kept
        return sum(words.values()), max(words.values(), default=0.0), len(words)


def inputs(matcher: Matcher, texts: list[str]) -> tuple[np.ndarray, list[int]]:
    """The curve's inputs for each text, and the number of matched words."""
    rows, hits = [], []
    for text in texts:
        folded = fold(text)
        total, top, matched = matcher.measure(folded)
        words = max(folded.count(" ") - 1, 1)
        rows.append((min(total * SPREAD / (words + 20), LIMIT), top))
        hits.append(matched)
    return np.array(rows, dtype=float).reshape(-1, 2), hits


def scores(lexicon: Lexicon, x: np.ndarray) -> np.ndarray:
    a, b, c = lexicon.curve
    return 1 / (1 + np.exp(-np.clip(a + b * x[:, 0] + c * x[:, 1], -50, 50)))


@functools.lru_cache(maxsize=2)
def _matcher(key: str, lexicon_items: tuple, exceptions: tuple[str, ...]) -> Matcher:
    return Matcher(Lexicon(dict(lexicon_items), exceptions))


def _kernel(texts: list[str], lexicon: Lexicon) -> dict[str, list]:
    matcher = _matcher(lexicon.key, tuple(lexicon.weights.items()), lexicon.exceptions)
    x, hits = inputs(matcher, texts)
    return {"score": scores(lexicon, x).tolist(), "n_matches": hits}


def terms_of(folded: str) -> set[str]:
    """Entries that a text supports: its words, and their beginnings."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        for size in PREFIXES:
            if len(word) > size:
                out.add(f" {word[:size]}")
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic documents, other documents), summed within a batch; the term None counts documents."""
    names = ["term", "toxic", "other"]
    for batch in batches:
        seen = Counter(), Counter()
        for part, texts in text_slices(batch, "text"):
            labels = part.column(part.schema.get_field_index("label")).to_pylist()
            for text, label in zip(texts, labels):
                own = seen[0 if label else 1]
                own.update(terms_of(fold(text)))
                own[None] += 1
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([
            pa.array(terms, type=pa.string()),
            pa.array([seen[0][t] for t in terms], type=pa.int64()), pa.array([seen[1][t] for t in terms], type=pa.int64()),
        ], names=names)


def learnable(id_col: str) -> Column:
    """Rows that labels may be learnt from."""
    return id_crc(F.col(id_col)) % 5 != 0


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = SAMPLE_DOCS,
) -> Lexicon:
    """The lexicon and its curve, from at most ``per_class`` documents of either label.

    Without labels of both classes the lexicon is SEED_WORDS and the curve a stated one.
    """
    seed = {f" {w} ": SEED_WEIGHT for w in SEED_WORDS}
    drawn = stage(labelled_sample(docs, labels, label_col, per_class, learnable(id_col), id_col, text_col).dropDuplicates([id_col]), "toxicity")
    side = F.pmod(F.xxhash64(F.col(id_col), F.lit("half")), F.lit(2))
    counts = (
        drawn.where(side == 0).select("text", "label").mapInArrow(_count, "term string, toxic long, other long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    totals = counts.where("term is null").first()
    n_toxic, n_other = (totals["toxic"], totals["other"]) if totals else (0, 0)
    if not (n_toxic and n_other):
        return Lexicon(seed, key="seed")

    def odds(n: str, total: int) -> Column:
        return F.log((F.col(n) + 0.5) / (total - F.col(n) + 0.5))

    # the lower end of the ratio's confidence interval: rare terms need clearer cases
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    weight = odds("toxic", n_toxic) - odds("other", n_other) - CONFIDENCE * error

    best = (
        counts.where(F.col("term").isNotNull() & (F.col("toxic") >= MIN_TOXIC))
        .select("term", weight.alias("weight"))
        .where(F.col("weight") >= MIN_WEIGHT).collect()
    )
    weights = dict(seed)
    for row in best:
        weights[row["term"]] = max(row["weight"], weights.get(row["term"], 0.0))
    lexicon = Lexicon(weights)
    rest = drawn.where(side == 1).select("label", "text")
    measured = map_texts(rest, functools.partial(_inputs_kernel, lexicon=lexicon), "per_words double, top double").collect()
    y = np.array([r["label"] for r in measured], dtype=float)
    x = np.array([(r["per_words"], r["top"]) for r in measured], dtype=float).reshape(-1, 2)
    return Lexicon(weights, curve=_curve(x, y), key=str(hash(tuple(sorted(weights.items())))))


def _inputs_kernel(texts: list[str], lexicon: Lexicon) -> dict[str, np.ndarray]:
    x, _ = inputs(_matcher("learning", tuple(lexicon.weights.items()), lexicon.exceptions), texts)
    return {"per_words": x[:, 0], "top": x[:, 1]}


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small penalty, by Newton's method; the two classes weigh the same."""
    if len(set(y)) < 2:
        return Lexicon.curve
    rows = np.hstack([np.ones((len(x), 1)), x])
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    theta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ theta, -30, 30)))
        grad = rows.T @ (weight * (y - p)) - 0.1 * theta
        hess = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(3)
        theta = theta + np.linalg.solve(hess, grad)
    return tuple(float(t) for t in theta)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_matches) for each row of ``docs``; the score lies between 0 and 1, higher for more toxic.

    Of the sum of weights per SPREAD words no more than LIMIT counts.

    Null and empty texts match nothing and get the curve's lowest score. Repeated
    rows are scored each; extra columns are ignored. Nothing is shuffled.
    """
    rows = docs.select(id_col, F.col(text_col).alias("text"))
    return map_texts(rows, functools.partial(_kernel, lexicon=lexicon), "score double, n_matches long")
