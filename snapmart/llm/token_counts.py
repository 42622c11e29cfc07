"""Token counts by a unigram segmentation whose forward scores live in a trie of pre-tokens.

A text is cut into pre-tokens (letters, digits, punctuation, blanks), and every
pre-token into the pieces of a public vocabulary with the best total score. The
forward score of a prefix, i.e. the best score of any segmentation of it, does
not depend on what follows; so the distinct pre-tokens are inserted into a trie
and the score is worked out once per node, with the number of pieces on the best
path beside it. The count of a pre-token is the one stored at its last node.

The vocabulary is a rank file; a piece's log probability is that of Zipf's law at
its rank, so nothing is trained. All 256 bytes are pieces, so every text can be cut.
"""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterable

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_texts

#: A trie beyond so many nodes is dropped and begun anew; bounds a worker's memory.
MAX_NODES = 1_500_000
#: Counts are kept from slice to slice up to so many bytes of pre-tokens and their entries.
MAX_KEPT = 100_000_000
#: Longer pre-tokens are scored beside the trie: their prefixes are hardly shared.
MAX_SHARED = 64
#: Pieces are found by their last so many bytes; shorter ones are tried at every place.
_TAIL = 3
_SHORT = tuple(range(_TAIL - 1, 0, -1))
#: Bytes that a kept count takes beside its pre-token, about.
_ENTRY = 150


def zipf_scores(path: str) -> dict[bytes, float]:
    """Pieces of a rank file with the log of 1 / (rank + 1), normalised over the file."""
    ranks: dict[bytes, int] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                piece, rank = line.split()
                ranks[base64.b64decode(piece)] = int(rank)
    total = math.log(sum(1.0 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class PrefixTrie:
    """Trie of pre-tokens with the forward score and piece count of each prefix.

    Among equally good segmentations the one with the longest last piece counts.
    """

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES, max_kept: int = MAX_KEPT) -> None:
        self._scores, self._max_nodes, self._max_kept = scores, max_nodes, max_kept
        self._longest = max(map(len, scores))
        lengths: dict[bytes, set[int]] = {}
        for piece in scores:
            if len(piece) >= _TAIL:
                lengths.setdefault(piece[-_TAIL:], set()).add(len(piece))
        #: Lengths, longest first, of the pieces that end in these bytes; no other length is tried.
        self._lengths = {tail: (*sorted(found, reverse=True), *_SHORT) for tail, found in lengths.items()}
        self._terminal: dict[str, int] = {}
        self._kept = 0
        self._reset()

    def _reset(self) -> None:
        self._next: dict[int, int] = {}
        self._best, self._pieces = [0.0], [0]

    def insert(self, words: Iterable[str]) -> dict[str, int]:
        """Piece count of each of ``words``; new ones are added in order, so that neighbours share their path.

        Nodes and kept counts may be dropped between two words, never a count that is returned.
        """
        words = set(words)
        counts = {word: self._terminal[word] for word in words if word in self._terminal}
        for word in sorted(words - counts.keys()):
            if len(self._best) > self._max_nodes:
                self._reset()
            if self._kept > self._max_kept:
                self._terminal, self._kept = {}, 0
            raw = word.encode("utf-8", "surrogatepass")
            counts[word] = self._terminal[word] = self._walk(raw) if len(raw) <= MAX_SHARED else self._alone(raw)
            self._kept += len(raw) + _ENTRY
        return counts

    def _walk(self, raw: bytes) -> int:
        node, best, pieces = 0, [0.0], [0]
        for at, byte in enumerate(raw):
            step = node << 8 | byte
            node = self._next.get(step)
            if node is None:
                node = self._next[step] = len(self._best)
                top, count = self._forward(raw, at + 1, best, pieces, 0)
                self._best.append(top)
                self._pieces.append(count)
            best.append(self._best[node])
            pieces.append(self._pieces[node])
        return pieces[-1]

    def _forward(self, raw: bytes, end: int, best: list[float], pieces: list[int], base: int) -> tuple[float, int]:
        top, count = -math.inf, 0
        for length in self._lengths.get(raw[max(base, end - _TAIL):end], _SHORT):
            begin = end - length
            if begin < base:
                continue
            score = self._scores.get(raw[begin:end])
            if score is not None and best[begin - base] + score > top:
                top, count = best[begin - base] + score, pieces[begin - base] + 1
        return top, count

    def _alone(self, raw: bytes) -> int:
        best, pieces, base = [0.0], [0], 0
        for end in range(1, len(raw) + 1):
            top, count = self._forward(raw, end, best, pieces, base)
            best.append(top)
            pieces.append(count)
            if len(best) > 4 * self._longest:  # older prefixes are out of any piece's reach
                drop = len(best) - self._longest - 1
                del best[:drop], pieces[:drop]
                base += drop
        return pieces[-1]

    def counts(self, words: list[str]) -> int:
        """Sum of the counts of ``words``, repeated ones each."""
        known = self.insert(words)
        return sum(map(known.__getitem__, words))

    @property
    def nodes(self) -> int:
        return len(self._best)


@functools.cache
def _trie(path: str) -> PrefixTrie:
    return PrefixTrie(zipf_scores(path))


def _kernel(texts: list[str], path: str, pattern: str) -> dict[str, list[int]]:
    trie, cut = _trie(path), regex.compile(pattern)
    split = [cut.findall(text) for text in texts]
    known = trie.insert(set().union(*map(set, split)))
    return {
        "n_tokens": [sum(map(known.__getitem__, words)) for words in split],
        "n_pretokens": [len(words) for words in split],
    }


def count_tokens(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, n_tokens, n_pretokens and n_bytes (UTF-8).

    ``vocabulary`` is the path of a rank file present on every worker, ``pattern``
    the regular expression of its pre-tokens. A null or empty text has counts of
    0; repeated rows and ids each keep their row; other columns are ignored, so
    their names cannot clash. Nothing is shuffled: a task holds one batch of texts
    with the counts of its pre-tokens, a trie of about MAX_NODES nodes and MAX_KEPT
    bytes of counts; whatever they drop is worked out again when it is met again.
    """
    rows = docs.select(F.col(id_col), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    counted = map_texts(rows, functools.partial(_kernel, path=vocabulary, pattern=pattern), "n_tokens long, n_pretokens long")
    return counted.select(id_col, "n_tokens", "n_pretokens", "n_bytes")
