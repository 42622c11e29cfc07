"""Packing along a space-filling curve.

A document becomes a hashed vector of its tokens, a fixed random projection takes
the vector to a few dimensions, and its place there gives a Hilbert key. The rows
are range-sorted by that key, so that neighbours on the curve stand side by side,
and are packed in this order: a sequence is filled to the last token and the
document that doesn't fit goes on in the next one.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from snapmart.llm.common import map_texts, stage

SEQUENCE = 4096
BUCKETS, DIMS, BITS = 1024, 4, 12

#: Entries of a worker's memory of words and of pre-tokens.
MAX_WORDS = 400_000

#: Characters whose classes and lower case are the same for Python and the tokenizer.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-įĲ-ž]*")
#: Pre-tokens of a lower-case word of such characters.
_PARTS = re.compile("'(?:s|t|re|ve|m|ll|d)|[^\\W\\d_]+|\\d|[^\\sa-z0-9À-ÖØ-öø-ž]+")


class WordTokenizer:
    """Token ids of whole texts as little-endian bytes, by a tokenizer file.

    The tokenizer drops blanks and never joins what stands on both sides of one,
    so ids are worked out per word and remembered. Words of plain letters are cut
    further, into pre-tokens; all other words go through the tokenizer as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self._all = Tokenizer.from_file(path)
        self._model = self._all.model
        self._bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = "<u2" if self._all.get_vocab_size() <= 1 << 16 else "<u4"
        self._words: dict[str, bytes] = {"": b""}
        self._parts: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        got = self._parts.get(part)
        if got is None:
            mapped = part if part.isascii() else self._bytes.pre_tokenize_str(part)[0][0]
            got = self._pack([t.id for t in self._model.tokenize(mapped)])
            if len(self._parts) < MAX_WORDS:
                self._parts[part] = got
        return got

    def _word(self, word: str) -> bytes:
        # "<|" could open a special token, which only the whole tokenizer knows
        if "<|" not in word and _PLAIN.fullmatch(word):
            got = b"".join(map(self._part, _PARTS.findall(word.lower())))
        else:
            got = self._pack(self._all.encode(word, add_special_tokens=False).ids)
        if len(self._words) < MAX_WORDS and len(word) < 64:
            self._words[word] = got
        return got

    def ids(self, text: str) -> bytes:
        known, out = self._words, []
        for word in text.replace("\n", " ").split(" "):
            got = known.get(word)
            out.append(self._word(word) if got is None else got)
        return b"".join(out)


@functools.cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


@functools.cache
def _projection(buckets: int, dims: int) -> np.ndarray:
    return np.random.default_rng(20240607).standard_normal((buckets, dims))


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows of ``cells``, below 2**bits)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    # undo the rotations of the curve from the top bit down (Skilling 2004)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def document_cells(ids: list[np.ndarray], buckets: int = BUCKETS, dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Hashed count vectors (unit length), projected and cut to a grid by the normal curve."""
    vectors = np.zeros((len(ids), buckets))
    for row, own in enumerate(ids):
        if len(own):
            hashed = (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(math.log2(buckets)))
            counts = np.sqrt(np.bincount(hashed.astype(np.int64), minlength=buckets))
            vectors[row] = counts / np.linalg.norm(counts)
    spread = vectors @ _projection(buckets, dims)
    share = 1.0 / (1.0 + np.exp(-1.702 * spread))  # the logistic curve is close to the normal one
    return np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def _kernel(texts: list[str], path: str, end_id: int) -> dict[str, list]:
    tokenizer = _tokenizer(path)
    last = np.array([end_id], dtype=tokenizer.dtype).tobytes()
    packed = [tokenizer.ids(text) + last for text in texts]
    keys: list[int] = []
    for at in range(0, len(packed), 512):
        part = [np.frombuffer(p, dtype=tokenizer.dtype) for p in packed[at : at + 512]]
        keys += hilbert_key(document_cells(part), BITS).tolist()
    width = int(tokenizer.dtype[-1])
    return {"hilbert_key": keys, "doc_tokens": [len(p) // width for p in packed], "width": [width] * len(packed), "token_ids": packed}


def _numbered(df: DataFrame) -> DataFrame:
    """Rows with a number of their own, fixed as soon as the frame is staged."""
    return df.withColumn("row_number", F.monotonically_increasing_id())


class _Packer:
    """Fills sequences of ``size`` tokens; pieces of the open one wait until it is full."""

    def __init__(self, base: int, size: int) -> None:
        self._next, self._size = base, size
        self._open: list[tuple] = []
        self._filled = 0
        self.ready: list[tuple] = []

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while start < total:
            take = min(total - start, self._size - self._filled)
            self._open.append((doc, start, ids[start : start + take]))
            self._filled += take
            start += take
            if self._filled == self._size:
                self._close(self._open)
                self._open, self._filled = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids in pieces:
            self.ready.append((doc, start, ids, self._next, offset))
            offset += len(ids)
        self._next += 1

    def finish(self) -> None:
        """Cut what is left at powers of two, largest first: no sequence needs padding."""
        left, pieces = self._filled, self._open
        while left:
            want = 1 << (left.bit_length() - 1)
            taken, rest, got = [], [], 0
            for doc, start, ids in pieces:
                use = min(len(ids), want - got)
                if use:
                    taken.append((doc, start, ids[:use]))
                if use < len(ids):
                    rest.append((doc, start + use, ids[use:]))
                got += use
            self._close(taken)
            pieces, left = rest, left - want
        self._open, self._filled = [], 0


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents, placed in sequences of at most ``size`` tokens.

    Columns: the id, ``start`` and ``length`` (of the piece in its document),
    ``doc_tokens``, ``sequence_id``, ``offset`` (of the piece in its sequence),
    ``hilbert_key`` and ``ids`` (the piece's tokens, little-endian 32-bit). Each
    range of the curve is packed by one task, in order; all of its sequences are
    full but the last ones, which are cut at powers of two. ``sequence_id`` is
    unique, not gapless.

    A null text counts as empty: one token, ``end_id``. Repeated rows are packed
    each; equal keys are dealt out by row number, so a third of all rows on one
    key still spreads over many tasks. Other columns are ignored. ``tokenizer``
    is the path of a file present on every worker. No document is held in more
    than one batch, and a task holds one open sequence.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    tokens = stage(_numbered(map_texts(
        rows, functools.partial(_kernel, path=tokenizer, end_id=end_id),
        "hilbert_key long, doc_tokens long, width int, token_ids binary",
    )), "packing")
    order = tokens.repartitionByRange("hilbert_key", "row_number").sortWithinPartitions("hilbert_key", "row_number")
    names = ("start", "length", "doc_tokens", "sequence_id", "offset", "hilbert_key")
    schema = StructType([docs.select(id_col).schema[0], *(StructField(n, LongType()) for n in names)]).add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        packer = _Packer(TaskContext.get().partitionId() << 40, size)

        def made() -> pa.RecordBatch:
            pieces, packer.ready = packer.ready, []
            rows = [
                (doc[0], start, len(ids), doc[1], sequence, offset, doc[2], ids.astype("<u4").tobytes())
                for doc, start, ids, sequence, offset in pieces
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), target)], schema=target)

        for batch in batches:
            ids_at, key_at, total_at, width_at, tokens_at = (
                batch.schema.get_field_index(c) for c in (id_col, "hilbert_key", "doc_tokens", "width", "token_ids"))
            for row in range(batch.num_rows):
                doc = (batch.column(ids_at)[row].as_py(), batch.column(total_at)[row].as_py(), batch.column(key_at)[row].as_py())
                packer.add(doc, np.frombuffer(batch.column(tokens_at)[row].as_py(), dtype=f"<u{batch.column(width_at)[row].as_py()}"))
                if len(packer.ready) >= 2000:
                    yield made()
        packer.finish()
        if packer.ready:
            yield made()

    return order.mapInArrow(run, schema)
