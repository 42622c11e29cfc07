"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A data file is a run of records. Each record is framed: eight bytes with the length of the
payload, the masked checksum of these eight bytes, the payload, the masked checksum of
the payload. All numbers are little-endian. The payload is the id of the document (eight bytes, signed),
one byte that is 1 for a null id, one byte with the width of a token id, and the token ids.
Beside ``x.rec`` stands ``x.idx``: one record in the same frame, whose payload has three
unsigned 64-bit numbers for each record of ``x.rec``: its offset, the length of its payload, and the
token ids before it in the file.

A checksum is the CRC-32 of zlib, rotated right by 15 bits plus a constant, so that a
checksum stored inside data that are checked again doesn't weaken the outer one.

Files get a new name in each task attempt; those of an attempt that succeeded, and
no others, are listed in a table that Spark writes and commits. A lost executor or a repeated task thus
leaves a stray file at worst, never a listed one twice.
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import stage, text_slices
from snapmart.session import scratch_path

#: A data file is closed when it holds so many bytes (one longer record has a file of its own).
FILE_BYTES = 32 << 20
#: Text bytes of one task of the range sort.
RANGE_BYTES = 64 << 20
#: Entries of a worker's memory of pieces of text, and the longest piece it keeps.
MAX_KNOWN, MAX_PIECE = 400_000, 64

# Rotation and constant of a masked checksum.
ROTATE, MASK = 15, 0xA282EAD8

_LENGTH, _CHECK, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB")
#: What a frame adds to its payload.
FRAME_BYTES = _LENGTH.size + 2 * _CHECK.size

#: Blanks other than the six of ASCII, and control characters that only one of Python and the tokenizer calls blank.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A word with the blanks before it.
_PIECE = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Texts of these characters alone are cut into pre-tokens here: their classes are beyond doubt.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ſ]*")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_PRE_TOKEN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")


class ByteTokenizer:
    """Token ids of whole texts by a byte-level tokenizer file, as little-endian bytes.

    Most texts are plain: they are cut into the tokenizer's pre-tokens, and the library's merges are
    worked out once for each pre-token that is remembered. In other texts the tokenizer never joins a character with a
    blank after it, so they fall into words with the blanks before them, each encoded by the library as it is.
    Texts with other blanks than ASCII's go through the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._all = Tokenizer.from_file(path)
        self._model = self._all.model
        # byte-level vocabularies write a byte that is no visible character as one from 256 on
        hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        self._visible = {b: 256 + i for i, b in enumerate(hidden)}
        self._special = re.compile("|".join(re.escape(t.content) for t in self._all.get_added_tokens_decoder().values()) or "(?!)")
        self.width = 2 if self._all.get_vocab_size() <= 1 << 16 else 4
        self._known: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def _keep(self, memory: dict[str, bytes], part: str, got: bytes) -> bytes:
        if len(memory) < MAX_KNOWN and len(part) <= MAX_PIECE:
            memory[part] = got
        return got

    def _pre_token(self, part: str) -> bytes:
        mapped = part.encode().decode("latin-1").translate(self._visible)
        return self._keep(self._known, part, self.pack([t.id for t in self._model.tokenize(mapped)]))

    def _whole(self, text: str) -> bytes:
        return self.pack(self._all.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if _ODD.search(text):
            return self._whole(text)
        if _PLAIN.fullmatch(text) and not self._special.search(text):
            known = self._known.get
            return b"".join([known(part) or self._pre_token(part) for part in _PRE_TOKEN.findall(text)])
        known = self._pieces.get
        return b"".join([known(piece) or self._keep(self._pieces, piece, self._whole(piece)) for piece in _PIECE.findall(text)])


@functools.cache
def _tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def masked(data: bytes) -> int:
    """Checksum of ``data``, rotated and shifted by a constant."""
    crc = zlib.crc32(data)
    return ((crc >> ROTATE | crc << (32 - ROTATE)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """``payload`` as one record."""
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))))


def unframe(data: bytes | memoryview, at: int = 0) -> tuple[memoryview, int]:
    """(payload, offset of the next record) of the record at ``at``; ValueError where it is cut short or doesn't check."""
    view = memoryview(data)
    body = at + _LENGTH.size + _CHECK.size
    if body > len(view) or _CHECK.unpack_from(view, at + _LENGTH.size)[0] != masked(view[at : at + _LENGTH.size]):
        raise ValueError(f"no record begins at byte {at}")
    end = body + _LENGTH.unpack_from(view, at)[0]
    if end + _CHECK.size > len(view) or _CHECK.unpack_from(view, end)[0] != masked(view[body:end]):
        raise ValueError(f"the record at byte {at} is damaged")
    return view[body:end], end + _CHECK.size


def _payload(doc_id: int | None, width: int, ids: bytes) -> bytes:
    return _HEAD.pack(doc_id or 0, doc_id is None, width) + ids


def _content(payload: memoryview) -> tuple[int | None, np.ndarray]:
    doc_id, missing, width = _HEAD.unpack_from(payload)
    return None if missing else doc_id, np.frombuffer(payload, dtype=f"<u{width}", offset=_HEAD.size)


def _open(path: str):
    """(file system, path in it) of a Hadoop-style URI."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def _read(path: str) -> pa.Buffer:
    system, where = _open(path)
    with system.open_input_file(where) as source:
        return source.read_buffer()


class _Writer:
    """Gathers records, and writes them with their index when a file is full."""

    def __init__(self, root: str, file_bytes: int) -> None:
        self._root, self._most = root, file_bytes
        self._part = TaskContext.get().partitionId()
        self._number = 0
        self._records: list[bytes] = []
        self._index: list[tuple[int, int, int]] = []
        self._size = self._tokens = 0

    def add(self, doc_id: int | None, width: int, ids: bytes) -> tuple | None:
        """The listing of the file that this record filled, if it did."""
        record = frame(_payload(doc_id, width, ids))
        self._index.append((self._size, len(record) - FRAME_BYTES, self._tokens))
        self._records.append(record)
        self._size += len(record)
        self._tokens += len(ids) // width
        return self.close() if self._size >= self._most else None

    def close(self) -> tuple | None:
        if not self._records:
            return None
        path = f"{self._root}/{self._part:06d}-{self._number:06d}-{uuid.uuid4().hex}"
        system, where = _open(path)
        system.create_dir(where.rpartition("/")[0], recursive=True)
        index = frame(np.array(self._index, dtype="<u8").tobytes())
        for name, parts in ((f"{where}.rec", self._records), (f"{where}.idx", [index])):
            with system.open_output_stream(name) as out:
                for part in parts:
                    out.write(part)
        listed = (self._part, self._number, path, len(self._records), self._tokens, self._size)
        self._number, self._records, self._index, self._size, self._tokens = self._number + 1, [], [], 0, 0
        return listed


_LISTING = "part int, number int, path string, n_records long, n_tokens long, n_bytes long"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def write_records(
    docs: DataFrame,
    tokenizer: str,
    root: str | None = None,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the token ids of ``docs`` below ``root``, in ascending order of the id; returns the listing.

    Columns of the listing: ``part`` and ``number`` (their order is that of the records), ``path`` (without
    ``.rec`` and ``.idx``), ``n_records``, ``n_tokens``, ``n_bytes``, and ``first_token``: the token ids in all files before.
    ``root`` is a folder that all executors reach, by default a new one below ``spark.checkpoint.dir``, deleted
    when the driver ends. ``tokenizer`` is the path of a file present on every worker.

    Ids are whole numbers; rows with a null id come first, rows with the same id in the order
    in which they were read, a record each. A null text counts as empty: one token, ``end_id``. Other columns
    are ignored. An empty table gives no file and an empty listing.

    The rows are sorted by ranges of the id, each of about RANGE_BYTES of text, and encoded as they are written: token
    ids are never shuffled, and a task holds one open file. A number of the row deals out rows that share an id. A task that is
    repeated must therefore meet its rows in the same order, as it does where ``docs`` is read from files.
    """
    spark = docs.sparkSession
    root = root or scratch_path(spark, "records")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row_number"))
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    order = rows.repartitionByRange(ranges, "id", "row_number").sortWithinPartitions("id", "row_number").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, writer, listed = _arrow(_LISTING), _Writer(root, file_bytes), []
        encoder = _tokenizer(tokenizer)
        end = encoder.pack([end_id])
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), texts):
                    listed.append(writer.add(doc_id, encoder.width, encoder.ids(text) + end))
        listed.append(writer.close())
        yield _rows([x for x in listed if x], target)

    return _placed(stage(order.mapInArrow(run, _LISTING), "record-files"))


def _placed(files: DataFrame, block: int = 1024) -> DataFrame:
    """``files`` with ``first_token``; sums run inside blocks of parts, then over one row for each block."""
    files = files.withColumn("block", F.floor(F.col("part") / block))
    blocks = files.groupBy("block").agg(F.sum("n_tokens").alias("total")).select(
        "block", F.coalesce(F.sum("total").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        files.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(blocks, "block")
        .withColumn("first_token", F.col("base") + F.col("inside")).drop("block", "base", "inside"))


_RECORDS = "id long, start long, n_tokens long, ids binary"


def _record(payload: memoryview, start: int) -> tuple:
    doc_id, ids = _content(payload)
    return doc_id, start, len(ids), ids.astype("<u4").tobytes()


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(c) for c in row if isinstance(c, (bytes, str)))
        if size >= most:
            yield _rows(held, schema)
            held, size = [], 0
    if held:
        yield _rows(held, schema)


def _spread(files: DataFrame) -> DataFrame:
    """One task for each few files, whatever the layout of the listing."""
    return files.repartition(max(1, files.count()))


def read_records(files: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids) of every record of the listed files; every checksum is checked.

    ``start`` counts the token ids of all records before, ``ids`` are 32-bit little-endian numbers. A file that is
    cut short, damaged or at odds with its index fails the read.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data, at = _read(f"{path}.rec"), 0
                for offset, length, before in _entries(path):
                    payload, end = unframe(data, at)
                    if offset != at or len(payload) != length:
                        raise ValueError(f"{path}: the index doesn't fit the records")
                    yield _record(payload, first + before)
                    at = end
                if at != len(data):
                    raise ValueError(f"{path}: more records than the index has")

    return _spread(files.select("path", "first_token")).mapInArrow(lambda batches: _batched(rows(batches), _arrow(_RECORDS)), _RECORDS)


def _entries(path: str) -> list[list[int]]:
    payload, _ = unframe(_read(f"{path}.idx"))
    return np.frombuffer(payload, dtype="<u8").reshape(-1, 3).astype(np.int64).tolist()


_INDEX = "path string, offset long, length long, start long"


def offset_index(files: DataFrame) -> DataFrame:
    """(path, offset, length, start) of every record, read from the index files alone."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for offset, length, before in _entries(path):
                    yield path, offset, length, first + before

    return _spread(files.select("path", "first_token")).mapInArrow(lambda batches: _batched(rows(batches), _arrow(_INDEX)), _INDEX)


def read_at(entries: DataFrame, handles: int = 32) -> DataFrame:
    """(id, start, n_tokens, ids) of the records that rows of ``offset_index`` point to, in the order of the rows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        opened: OrderedDict = OrderedDict()
        for batch in batches:
            for path, offset, length, start in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if path not in opened:
                    if len(opened) >= handles:
                        opened.popitem(last=False)[1].close()
                    system, where = _open(f"{path}.rec")
                    opened[path] = system.open_input_file(where)
                opened.move_to_end(path)
                yield _record(unframe(opened[path].read_at(length + FRAME_BYTES, offset))[0], start)
        for source in opened.values():
            source.close()

    chosen = entries.select("path", "offset", "length", "start")
    return chosen.mapInArrow(lambda batches: _batched(rows(batches), _arrow(_RECORDS)), _RECORDS)


def read_shuffled(files: DataFrame, seed: int) -> DataFrame:
    """All records in an order that depends on ``seed`` alone: the index is shuffled, the records are read in place."""
    entries = offset_index(files).withColumn("key", F.xxhash64(F.lit(seed), "start"))
    return read_at(entries.repartitionByRange("key", "start").sortWithinPartitions("key", "start"))
