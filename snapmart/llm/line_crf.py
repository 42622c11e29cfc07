"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line is described by what it holds (shares of
character classes, word lengths, repeated words) and by the same figures of the
lines before and after it; the chain adds how good and bad lines follow each other.
The forward-backward algorithm gives each line's probability of being good, and
their mean, weighted by length, is the document's score.

The field is fitted on a bounded sample of labelled documents. Their lines carry
no labels of their own: a good document's lines are good, a bad one's begin as
bad, and lines of bad documents that the fitted field finds good change sides
before it is fitted again.
"""

from __future__ import annotations

import functools
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import byte_classes, id_crc, labelled_sample, map_texts

#: Labelled documents of each class in the sample that the field is fitted on.
SAMPLE_DOCS = 2_500
#: Lines of a document in the sample: of one with more lines, a stretch of so many; every document is scored whole.
SAMPLE_LINES = 128
#: Texts with more lines are scored by themselves, block by block.
LONG_LINES = 2_000
#: Lines, and bytes unless a line has more, whose features are held at once.
BLOCK_LINES, BLOCK_BYTES = 20_000, 2 << 20
#: Score from which a document counts as good.
GOOD = 0.7

_CLASSES = 9  # lower, upper, digit, blank, stop, exclamation, symbol, other, not ASCII
_OWN = 15


_TABLE = byte_classes()
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, bytes of each line, lines of each text); an empty text has one empty line."""
    return _line_features([t.encode("utf-8", "surrogatepass") for t in texts])


def _line_features(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lines_of = np.array([r.count(b"\n") + 1 for r in raw], dtype=np.int64)
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    breaks = data == 10
    total = int(lines_of.sum())
    line = np.cumsum(breaks) - breaks
    kinds = _TABLE[data]
    counts = np.bincount(line * 10 + kinds, minlength=total * 10).reshape(total, 10).astype(float)
    counts[:, 3] -= 1  # the break itself
    size = counts.sum(axis=1)
    blank = kinds == 3
    begins = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    own = np.zeros((total, _OWN))
    own[:, 11] = 1  # distinct words per word; a line without any has no repeats
    per = np.maximum(size - counts[:, 9], 1)
    own[:, :_CLASSES] = counts[:, :_CLASSES] / per[:, None]
    own[:, 9] = np.log1p(size)
    if len(begins):
        nth = np.cumsum(~blank & np.concatenate(([True], blank[:-1]))) - 1  # the word that a byte belongs to or follows
        place = np.arange(len(data)) - begins[np.maximum(nth, 0)]
        mixed = np.where(blank, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63])
        words = np.add.reduceat(mixed, begins)
        length = np.add.reduceat((~blank).astype(np.int64), begins)
        home = line[begins]
        n_words = np.bincount(home, minlength=total)
        some = np.maximum(n_words, 1)
        own[:, 10] = np.bincount(home, weights=length, minlength=total) / some
        order = np.lexsort((words, home))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (words[order][1:] != words[order][:-1]) | (home[order][1:] != home[order][:-1])
        own[:, 11] = np.where(n_words > 0, np.bincount(home[order][first], minlength=total) / some, 1)
        same = np.zeros(len(words), dtype=bool)
        same[1:] = (words[1:] == words[:-1]) & (home[1:] == home[:-1])
        own[:, 12] = np.bincount(home[same], minlength=total) / some
        own[:, 13] = np.bincount(home[length == 1], minlength=total) / some
        own[:, 14] = np.log1p(n_words)
    return own, size, lines_of


def _with_neighbours(own: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
    """Own features, those of the lines before and after (0 at the ends), the ends, and 1."""
    ends = np.cumsum(lines_of)
    first, last = np.zeros(len(own), dtype=bool), np.zeros(len(own), dtype=bool)
    first[ends - lines_of] = True
    last[ends - 1] = True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((len(own), 1))])


@dataclass(frozen=True)
class Field:
    """A fitted field: standardisation of own features, weights of a line's features, the chain's score of a change."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    chain: np.ndarray  # 2 x 2, from (bad, good) to (bad, good)

    def inputs(self, own: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
        return _with_neighbours(np.clip((own - self.mean) / self.scale, -6, 6), lines_of)


def _chain_order(lines_of: np.ndarray) -> list[np.ndarray]:
    """For each step, the places of the lines there, longest documents first."""
    order = np.argsort(-lines_of, kind="stable")
    starts = (np.cumsum(lines_of) - lines_of)[order]
    lengths = lines_of[order]
    alive = len(order) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), side="right")
    return [starts[:n] + step for step, n in enumerate(alive)]


def marginals(emission: np.ndarray, chain: np.ndarray, lines_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many documents at once.

    ``emission`` holds a line's score as good, against 0 as bad. Returns each line's
    probability of being good, the expected 2 x 2 counts of changes, and the sum
    of the log partition functions.
    """
    steps = _chain_order(lines_of)
    emit = np.stack([np.zeros_like(emission), emission], axis=1)
    top = emit.max(axis=1, keepdims=True)
    emit = np.exp(emit - top)
    move = np.exp(chain - chain.max())
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    norm = np.empty(len(emit))
    state = None
    for at in steps:
        state = emit[at] if state is None else (state[: len(at)] @ move) * emit[at]
        norm[at] = state.sum(axis=1)
        state = state / norm[at][:, None]
        forward[at] = state
    changes = np.zeros((2, 2))
    for here, after in zip(steps[-2::-1], steps[:0:-1]):
        prior = here[: len(after)]
        weight = emit[after] * backward[after] / norm[after][:, None]
        back = weight @ move.T
        changes += np.einsum("ni,ij,nj->ij", forward[prior], move, weight)
        backward[prior] = back
    both = forward * backward
    total = float(np.log(norm).sum() + top.sum() + chain.max() * (len(emit) - len(lines_of)))
    return both[:, 1] / both.sum(axis=1), changes, total


def long_marginals(emission: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Each line's probability of being good, for one long document.

    The chain is cut into as many blocks as a block has lines. A block is a product of 2 x 2
    matrices, worked out for all blocks at once; one pass over the blocks gives the messages that enter each, and a
    last one the lines inside. A few numbers per line are held.
    """
    n = len(emission)
    size = math.isqrt(n - 1) + 1
    blocks = -(-n // size)
    grid = np.zeros(blocks * size)
    grid[:n] = emission
    grid = grid.reshape(blocks, size)
    move = np.exp(chain - chain.max())
    real = np.arange(blocks) < n // size  # blocks without padding; the last may have some
    rest = n - (blocks - 1) * size

    def step(j: int) -> np.ndarray:
        top = np.maximum(grid[:, j], 0)
        made = move[None] * np.stack([np.exp(-top), np.exp(grid[:, j] - top)], axis=1)[:, None]
        if j == 0:
            made[0, 1] = made[0, 0] = np.array([math.exp(-top[0]), math.exp(grid[0, 0] - top[0])])
        if j >= rest and not real[-1]:
            made[-1] = np.eye(2)
        return made

    product = np.tile(np.eye(2), (blocks, 1, 1))
    for j in range(size):
        product = product @ step(j)
        product /= product.max(axis=(1, 2), keepdims=True)
    enter, leave = np.empty((blocks, 2)), np.ones((blocks, 2))
    enter[0] = 0.5
    for k in range(1, blocks):
        enter[k] = enter[k - 1] @ product[k - 1]
        enter[k] /= enter[k].sum()
    for k in range(blocks - 1, 0, -1):
        leave[k - 1] = product[k] @ leave[k]
        leave[k - 1] /= leave[k - 1].sum()
    forward = np.empty((blocks, size))
    for j in range(size):
        enter = (enter[:, None] @ step(j))[:, 0]
        enter /= enter.sum(axis=1, keepdims=True)
        forward[:, j] = enter[:, 1]
    for j in range(size - 1, -1, -1):
        good, bad = forward[:, j] * leave[:, 1], (1 - forward[:, j]) * leave[:, 0]
        forward[:, j] = good / (good + bad)
        leave = (step(j) @ leave[:, :, None])[:, :, 0]
        leave /= leave.sum(axis=1, keepdims=True)
    return forward.ravel()[:n]


def _long_emission(raw: bytes, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """(emission, bytes) of every line of one text; features are held for a block of lines and its two neighbours."""
    breaks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10)
    starts = np.concatenate(([0], breaks + 1))
    stops = np.concatenate((breaks, [len(raw)]))
    n, at = len(starts), 0
    emission, size = np.empty(n), np.empty(n, dtype=np.float32)
    own_w, before_w, after_w, ends_w = np.split(field.weights, [_OWN, 2 * _OWN, 3 * _OWN])
    while at < n:
        stop = int(min(at + BLOCK_LINES, max(np.searchsorted(stops, starts[at] + BLOCK_BYTES), at + 1), n))
        low, high = max(at - 1, 0), min(stop + 1, n)
        own, bytes_of, _ = _line_features([raw[starts[low] : stops[high - 1]]])
        z = np.clip((own - field.mean) / field.scale, -6, 6)
        here = slice(at - low, stop - low)
        part = z[here] @ own_w + ends_w[2]
        before, after = z @ before_w, z @ after_w
        part[(1 if at == 0 else 0) :] += before[(0 if at == 0 else here.start - 1) : here.stop - 1]
        part[: len(part) - (1 if stop == n else 0)] += after[here.start + 1 : here.stop + (0 if stop == n else 1)]
        if at == 0:
            part[0] += ends_w[0]
        if stop == n:
            part[-1] += ends_w[1]
        emission[at:stop], size[at:stop] = part, bytes_of[here]
        at = stop
    return emission, size


def _score_long(raw: bytes, field: Field) -> tuple[float, int, int]:
    emission, size = _long_emission(raw, field)
    good = long_marginals(emission, field.chain)
    weight = size.astype(float) + 1e-6
    return float(np.clip((good * weight).sum() / weight.sum(), 0, 1)), len(good), int((good < 0.5).sum())


def _fit_once(x: np.ndarray, y: np.ndarray, lines_of: np.ndarray, weights: np.ndarray, chain: np.ndarray, steps: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood with a quadratic penalty, by Adam."""
    ends = np.cumsum(lines_of)
    inner = np.ones(len(y), dtype=bool)
    inner[ends - 1] = False
    pairs = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[pairs], y[pairs + 1]), 1)
    theta = np.concatenate([weights, chain.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(y)
    for step in range(1, steps + 1):
        good, changes, _ = marginals(x @ theta[:-4], theta[-4:].reshape(2, 2), lines_of)
        grad = np.concatenate([x.T @ (y - good), (seen - changes).ravel()]) / n - decay * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def fit(own: np.ndarray, lines_of: np.ndarray, labels: list[int], rounds: int = 2, steps: int = 250, decay: float = 1e-5) -> Field | None:
    """The field fitted on the line features of documents with labels 0 and 1; None unless both occur."""
    if len(set(labels)) < 2:
        return None
    mean, scale = own.mean(axis=0), own.std(axis=0) + 1e-3
    x = Field(mean, scale, np.empty(0), np.empty(0)).inputs(own, lines_of)
    given = np.repeat(np.array(labels, dtype=np.int64), lines_of)
    y, weights, chain = given, np.zeros(x.shape[1]), np.zeros((2, 2))
    for turn in range(rounds):
        weights, chain = _fit_once(x, y, lines_of, weights, chain, steps, decay)
        if turn + 1 < rounds:
            # a line of a bad document is good if its own features say so, whatever its neighbours are labelled
            good = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            y = np.where(given == 1, 1, (good > 0.5).astype(np.int64))
    return Field(mean, scale, weights, chain)


def score_texts(texts: list[str], field: Field | None) -> tuple[list[float], list[int], list[int]]:
    """(score, lines, bad lines) of each text. Features of some BLOCK_LINES lines are held at once."""
    if field is None:
        return [1.0] * len(texts), [t.count("\n") + 1 for t in texts], [0] * len(texts)
    rows: list[tuple[float, int, int]] = []
    group: list[bytes] = []
    lines = size = 0

    def flush() -> None:
        nonlocal lines, size
        if group:
            rows.extend(_score_group(group, field))
            group.clear()
            lines = size = 0

    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        own = raw.count(b"\n") + 1
        if own > LONG_LINES:
            flush()
            rows.append(_score_long(raw, field))
            continue
        if lines + own > BLOCK_LINES or size + len(raw) > BLOCK_BYTES:
            flush()
        group.append(raw)
        lines, size = lines + own, size + len(raw)
    flush()
    return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def _score_group(raw: list[bytes], field: Field) -> list[tuple[float, int, int]]:
    own, size, lines_of = _line_features(raw)
    good, _, _ = marginals(field.inputs(own, lines_of) @ field.weights, field.chain, lines_of)
    owner = np.repeat(np.arange(len(raw)), lines_of)
    weight = size + 1e-6
    score = np.bincount(owner, weights=good * weight, minlength=len(raw)) / np.bincount(owner, weights=weight, minlength=len(raw))
    bad = np.bincount(owner[good < 0.5], minlength=len(raw))
    return list(zip(np.clip(score, 0, 1).tolist(), lines_of.tolist(), bad.tolist()))


def _kernel(texts: list[str], field: Field | None) -> dict[str, list]:
    score, lines, bad = score_texts(texts, field)
    return {"score": score, "n_lines": lines, "n_bad_lines": bad}


def learnable(id_col: str) -> Column:
    """Rows that labels may be learnt from."""
    return id_crc(F.col(id_col)) % 4 != 2


def stretch(text: str, most: int = SAMPLE_LINES) -> str:
    """The text, or ``most`` lines in a row of one that has more, from a place that its checksum decides."""
    lines = text.split("\n")
    if len(lines) <= most:
        return text
    at = zlib.crc32(text.encode("utf-8", "surrogatepass")) % (len(lines) - most + 1)
    return "\n".join(lines[at : at + most])


def _features_kernel(texts: list[str]) -> dict[str, list]:
    own, _, lines_of = line_features([stretch(t) for t in texts])
    return {"lines": lines_of.tolist(), "own": [part.ravel() for part in np.split(own, np.cumsum(lines_of)[:-1])]}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = SAMPLE_DOCS) -> Field | None:
    """The field, fitted on at most ``per_class`` documents of either label.

    Documents of any length are drawn; at most SAMPLE_LINES lines of each are learnt from. Their texts stay
    with the executors; the driver gets the features of their lines. None where
    the sample lacks a class, for instance with an empty table of labels.
    """
    drawn = labelled_sample(docs, labels, label_col, per_class, learnable(id_col), id_col, text_col).dropDuplicates([id_col])
    rows = map_texts(drawn.select(F.col(id_col).alias("id"), "label", "text"), _features_kernel, "lines long, own array<float>").collect()
    rows.sort(key=lambda r: r["id"])
    own = np.concatenate([np.array(r["own"], dtype=float) for r in rows] or [np.empty(0)]).reshape(-1, _OWN)
    return fit(own, np.array([r["lines"] for r in rows], dtype=np.int64), [r["label"] for r in rows])


def score(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_lines, n_bad_lines) for each row of ``docs``.

    The score lies between 0 and 1, higher for better. Null and empty texts have
    one empty line and are scored by it. Without a field (no labels to learn
    from) every score is 1. Repeated rows are scored each; extra columns are ignored.
    """
    rows = docs.select(id_col, F.col(text_col).alias("text"))
    return map_texts(rows, functools.partial(_kernel, field=field), "score double, n_lines long, n_bad_lines long")


def keep_good(docs: DataFrame, field: Field | None, text_col: str = "text", least: float = GOOD) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``; columns as given."""
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts([t or "" for t in texts], field)[0], dtype=float)

    return docs.where(F.pandas_udf(scored, "double")(F.col(text_col)) >= least)
