"""Benchmark decontamination by pigeonhole pieces and bit-parallel edit distance.

A test item with an error budget of k is cut into k + 1 pieces. Whatever k edits
do to a copy, one piece survives unchanged; so every copy within the budget has an
exact piece hit. Hits are found for all pieces at once by an Aho-Corasick machine,
each hit says where the item would begin, and Myers' bit-parallel algorithm gives
the edit distance of the best match around that place.

Short items have no budget; they are found where they stand as whole words, so that
"art" is not found in "start". Scripts that write words without blanks have no such bounds.

Texts are compared in lower case with runs of blanks as one space.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from snapmart.llm.common import text_slices

#: Pieces have at least so many characters; the error budget of an item follows from it.
PIECE_CHARS = 16
#: Items compiled into one machine, and sent to the executors at once.
BLOCK_ITEMS = 20_000

_WORD = re.compile(r"\S+")
#: A character of a word, in scripts that put blanks between words.
_LETTER = regex.compile(
    r"(?V1)[[\p{L}\p{M}\p{N}_]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Yi}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}ー]]")


def _lower(text: str) -> str:
    low = text.lower()
    if len(low) != len(text):  # keep places: a letter whose lower case is longer stays
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def normalise(text: str) -> str:
    """Lower case, and one space for each run of blanks."""
    return " ".join(_lower(text).split())


def _origins(text: str) -> list[int]:
    """For each character of the normalised text, its place in the text."""
    places: list[int] = []
    for word in _WORD.finditer(text):
        if places:
            places.append(word.start() - 1)
        places.extend(range(word.start(), word.end()))
    return places


def error_budget(chars: int, piece_chars: int = PIECE_CHARS) -> int:
    """Edits allowed for an item: as many as leave every piece ``piece_chars`` long."""
    return max(0, chars // piece_chars - 1)


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(place, piece) of ``budget`` + 1 pieces that cover the item, as even as can be."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def stands_alone(text: str, start: int, stop: int) -> bool:
    """Whether neither end of text[start:stop] is within a word."""
    return not any(
        0 < at < len(text) and _LETTER.match(text[at - 1]) and _LETTER.match(text[at]) for at in (start, stop))


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end) of the substring of ``text`` closest to ``pattern``; the first such end.

    Myers' algorithm as Hyyro states it, with one machine word per pattern.
    """
    size = len(pattern)
    masks: dict[str, int] = {}
    for i, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, char in enumerate(text, 1):
        match = masks.get(char, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Finds copies of items, each within its error budget, in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], piece_chars: int = PIECE_CHARS) -> None:
        self._items = dict(items)
        self._budget = {key: error_budget(len(text), piece_chars) for key, text in items}
        self._whole = {key for key, text in items if not self._budget[key]}
        where: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            for place, piece in pieces(text, self._budget[key]):
                where.setdefault(piece, []).append((key, place))
        self._machine = ahocorasick.Automaton()
        for piece, uses in where.items():
            self._machine.add_word(piece, (len(piece), uses))
        if where:
            self._machine.make_automaton()
        self._empty = not where

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item -> (distance, start, stop) of its closest copy in ``text``, the first of equals."""
        if self._empty:
            return {}
        begins: dict[int, list[int]] = {}
        found: dict[int, tuple[int, int, int]] = {}
        for last, (size, uses) in self._machine.iter(text):
            for key, place in uses:
                if key not in self._whole:
                    begins.setdefault(key, []).append(last + 1 - size - place)
                elif key not in found and stands_alone(text, last + 1 - size, last + 1):
                    found[key] = 0, last + 1 - size, last + 1
        for key, starts in begins.items():
            if copy := self._closest(key, sorted(set(starts)), text):
                found[key] = copy
        return found

    def _closest(self, key: int, starts: list[int], text: str) -> tuple[int, int, int] | None:
        item, budget = self._items[key], self._budget[key]
        for start in starts:
            if start >= 0 and text.startswith(item, start):
                return 0, start, start + len(item)
        best = None
        for low, high in _windows(starts, budget, len(item), len(text)):
            distance, end = best_match(item, text[low:high])
            if distance <= budget and (best is None or distance < best[0]):
                _, length = best_match(item[::-1], text[max(low, low + end - len(item) - budget) : low + end][::-1])
                best = distance, low + end - length, low + end
        return best


def _windows(starts: list[int], budget: int, size: int, chars: int) -> Iterator[tuple[int, int]]:
    """Stretches of text that hold every match beginning within ``budget`` of a place."""
    low = high = None
    for start in starts:
        a, b = max(0, start - budget), min(chars, start + size + budget)
        if high is not None and a <= low + 2 * budget:
            high = b
        else:
            if high is not None:
                yield low, high
            low, high = a, b
    if high is not None:
        yield low, high


@functools.lru_cache(maxsize=2)
def _matcher(items: tuple[tuple[int, str], ...], piece_chars: int) -> Matcher:
    return Matcher(list(items), piece_chars)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    block: list[tuple[object, str]] = []
    for key, text in benchmark.select(item_col, text_col).toLocalIterator():
        text = normalise(text or "")
        if text:
            block.append((key, text))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def find_copies(
    docs: DataFrame,
    benchmark: DataFrame,
    piece_chars: int = PIECE_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, distance, start, stop): for each row and each item copied in it, the closest copy.

    Places are code points of the text as it is. All rows are searched for all
    items; the test items are the stated query set, read in blocks of BLOCK_ITEMS
    whose machines go to the executors, one pass over ``docs`` each. Nothing is
    shuffled, and one task holds one batch of texts.

    Null and empty texts hold no copies. Null and empty items are not searched for;
    an item of one common word is found in every text with that word. Repeated rows are
    searched each; a repeated item, under the same or another id, is found under each
    id once. Extra columns of either table are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where("length(__text) > 0")
    id_field, item_field = docs.select(id_col).schema[0], benchmark.select(item_col).schema[0]
    schema = StructType([
        StructField(id_col, id_field.dataType), StructField(item_col, item_field.dataType),
        StructField("distance", IntegerType()), StructField("start", LongType()), StructField("stop", LongType()),
    ])
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        keys: dict[str, list] = {}
        for key, text in block:
            if key not in keys.setdefault(text, []):
                keys[text].append(key)
        items = spark.sparkContext.broadcast((tuple(enumerate(keys)), list(keys.values())))
        found = rows.mapInArrow(functools.partial(_search, items=items, piece_chars=piece_chars, schema=schema), schema)
        out = found if out is None else out.unionAll(found)
    return spark.createDataFrame([], schema) if out is None else out


def _search(batches: Iterator[pa.RecordBatch], items: Broadcast, piece_chars: int, schema: StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    texts_of, keys = items.value
    matcher = _matcher(texts_of, piece_chars)
    for batch in batches:
        for part, texts in text_slices(batch, "__text"):
            rows = []
            ids = part.column(part.schema.get_field_index("__id"))
            for at, text in enumerate(texts):
                found = matcher.find(normalise(text))
                if not found:
                    continue
                places, doc = _origins(text), ids[at].as_py()
                for item, (distance, start, stop) in found.items():
                    rows += [(doc, key, distance, places[start], places[stop - 1] + 1) for key in keys[item]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), target)], schema=target)


def drop_copies(
    docs: DataFrame, benchmark: DataFrame, piece_chars: int = PIECE_CHARS, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no copy of any item; rows, columns and order of columns as given.

    Rows with a null or empty text are kept.
    """
    spark = docs.sparkSession
    schema = docs.schema
    for block in _blocks(benchmark, item_col, item_text_col):
        items = spark.sparkContext.broadcast((tuple(enumerate(dict.fromkeys(text for _, text in block))), None))
        docs = docs.mapInArrow(functools.partial(_clean, items=items, piece_chars=piece_chars, text_col=text_col), schema)
    return docs


def _clean(batches: Iterator[pa.RecordBatch], items: Broadcast, piece_chars: int, text_col: str) -> Iterator[pa.RecordBatch]:
    matcher = _matcher(items.value[0], piece_chars)
    for batch in batches:
        for part, texts in text_slices(batch, text_col):
            keep = pa.array([not (text and matcher.find(normalise(text))) for text in texts], type=pa.bool_())
            yield part.filter(keep)
