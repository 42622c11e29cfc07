"""A keyed Parquet table with versions.

Layout under ``root``::

    table_version=<n>-<id>/[p=../]part-*.parquet   the rows written with version n
    _current/part-*.json                           one small row per version: number, folder, schema, partitions, batch

A write goes to a folder of its own and never over an existing one; the row that
makes it current is written after the data, so readers never see half a version
and a failed run leaves the one before current. One writer at a time is assumed.

Where the partition columns belong to the merge key, a key can't move between
partitions, so an upsert reads and writes only the partitions that its source
touches. The row of such a version names them; every other partition is read
from the folder that held it before. The files of untouched partitions stay as they are.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators.upsert import assert_unique_keys, keys_may_repeat, upsert
from snapmart.sources.files import is_missing_path

_POINTER_SCHEMA = "version long, folder string, schema string, partitions string, batch string"
_FOLDER = "table_version"
#: Codec of the lake's files: keys and fingerprints are hex texts, which zstd halves and snappy does not.
CODEC = "zstd"


def literal_path(path: str) -> str:
    """``path`` for a reader, with the signs that readers take as patterns escaped."""
    return re.sub(r"([\[\]{}*?])", r"\\\1", path)


def _any_of(columns: Sequence[str], values: Sequence[Sequence[str | None]]) -> Column:
    """True where the columns, as text, hold one of the value tuples. Of partition columns: a condition on folders."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        known = [v for (v,) in values if v is not None]
        found = texts[0].isin(known) if known else F.lit(False)
        return F.coalesce(found, F.lit(False)) | texts[0].isNull() if len(known) < len(values) else found
    same = [reduce(lambda a, b: a & b, [t.eqNullSafe(F.lit(v)) for t, v in zip(texts, row)]) for row in values]
    return reduce(lambda a, b: a | b, same)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self.last_rows_written: int | None = None  # observed while writing (A10)

    def _versions(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_POINTER_SCHEMA).json(literal_path(f"{self.root}/_current"))
        except AnalysisException as exc:
            if is_missing_path(exc):
                return None
            raise

    def _record(self, version: int | None = None) -> Row | None:
        rows = self._versions()
        if rows is None:
            return None
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).limit(1).collect()
        return found[0] if found else None

    def current_version(self) -> int | None:
        record = self._record()
        return record.version if record else None

    def exists(self) -> bool:
        """True once a version is committed."""
        return self._record() is not None

    def version_of_batch(self, batch: str) -> int | None:
        """The version written for ``batch``, if there is one."""
        rows = self._versions()
        found = rows.filter(F.col("batch") == batch).limit(1).collect() if rows is not None else []
        return found[0].version if found else None

    def _folders(self, version: int) -> list[tuple[str, list[list[str | None]] | None]]:
        """The folders that hold a version, newest first, each with its partitions that are still valid (None: all others).

        One entry for each version back to the last that wrote the whole table, as
        long as it holds a valid partition: never more than the table has partitions.
        """
        rows = self._versions().filter(F.col("version") <= version).orderBy(F.desc("version")).toLocalIterator()
        found, replaced = [], set()
        for row in rows:
            if row.partitions is None:
                return [*found, (row.folder, None)]
            own = [v for v in map(tuple, json.loads(row.partitions)) if v not in replaced]
            if own:
                found.append((row.folder, [list(v) for v in own]))
                replaced.update(own)
        return found

    def read(self, version: int | None = None) -> DataFrame:
        """The current (or a given) version (S7): one scan of the folders that hold its partitions."""
        record = self._record(version)
        if record is None:
            raise FileNotFoundError(f"no committed version {version or ''} under {self.root}")
        schema = T.StructType.fromJson(json.loads(record.schema))
        folders = self._folders(record.version)
        if len(folders) == 1 and folders[0][1] is None:
            return self.spark.read.schema(schema).parquet(literal_path(f"{self.root}/{folders[0][0]}")).select(*schema.names)
        wide = T.StructType([*schema.fields, T.StructField(_FOLDER, T.StringType())])
        rows = self.spark.read.schema(wide).option("basePath", self.root).parquet(
            *[literal_path(f"{self.root}/{folder}") for folder, _ in folders])
        newer: list[list[str | None]] = []
        valid = F.lit(False)
        for folder, partitions in folders:
            here = F.col(_FOLDER) == folder.removeprefix(f"{_FOLDER}=")
            valid = valid | (here & (_any_of(self.partition_by, partitions) if partitions is not None else ~_any_of(self.partition_by, newer)))
            newer += partitions or []
        return rows.where(valid).select(*schema.names)

    def write(self, df: DataFrame, batch: str | None = None) -> int:
        """Commit ``df`` as the next version, replacing the whole table (K4)."""
        return self._write(df, df.schema, None, batch)

    def _write(
        self, df: DataFrame, schema: T.StructType, partitions: list | None, batch: str | None,
        check: Callable[[DataFrame], None] | None = None,
    ) -> int:
        """``check`` sees the written rows before they become a version; if it raises, they don't."""
        if _FOLDER in df.columns:
            raise ValueError(f"a column can't be called {_FOLDER!r}")
        version = (self.current_version() or 0) + 1
        folder = f"{_FOLDER}={version:08d}-{uuid.uuid4().hex[:8]}"
        # count the rows as they are written instead of scanning again
        observation = Observation()
        writer = df.observe(observation, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("compression", CODEC)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/{folder}")
        if check:
            check(self.spark.read.schema(schema).parquet(literal_path(f"{self.root}/{folder}")))
        self.last_rows_written = observation.get["rows"]
        pointer = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"), F.lit(schema.json()).alias("schema"),
            F.lit(None if partitions is None else json.dumps(partitions)).cast("string").alias("partitions"),
            F.lit(batch).cast("string").alias("batch"))
        pointer.coalesce(1).write.mode("append").json(f"{self.root}/_current")
        return version

    def upsert(self, source: DataFrame, keys: Sequence[str], check_duplicates: bool = True, batch: str | None = None) -> int:
        """Merge ``source`` on ``keys`` into a new version.

        The first load writes the source as version 1; the duplicate key check that a merge
        applies to its source reads the written keys before they become the version, so the source's
        plan runs once. With partition columns that belong to ``keys``
        only the partitions touched by ``source`` are read and written; the driver sees their
        values. A column whose type changes makes the whole table be rewritten, since
        old files hold the old type. ``last_rows_written`` counts the rows written.

        ``batch`` names what is merged: a batch that already has a version is
        not merged again, and that version's number is returned.
        """
        if batch is not None and (known := self.version_of_batch(batch)) is not None:
            return known
        record = self._record()
        if record is None:
            loaded = upsert(source.limit(0), source, keys, False)

            def check(written: DataFrame) -> None:
                # an empty text is read back from a partition's name as null
                if keys_may_repeat(written, keys, nulls_match=self.partition_by):
                    assert_unique_keys(source, keys)

            return self._write(loaded, loaded.schema, None, batch, check if check_duplicates else None)
        current = self.read()
        if not self.partition_by or not set(self.partition_by) <= set(keys) or not set(self.partition_by) <= set(source.columns):
            return self.write(upsert(current, source, keys, check_duplicates), batch)
        if check_duplicates:
            assert_unique_keys(source, keys)
        merged = upsert(current, source, keys, False)
        before, after = current.schema, merged.schema
        if any(after[f.name].dataType != f.dataType for f in before.fields):
            return self.write(merged, batch)
        texts = [F.col(c).cast("string").alias(c) for c in self.partition_by]
        touched = sorted([list(r) for r in source.select(*texts).distinct().collect()], key=str)
        if not touched:
            return self._write(merged.limit(0), after, [], batch)
        target = current.where(_any_of(self.partition_by, touched))
        own = set(target.columns) - set(source.columns)
        part = upsert(target, source, keys, False, unique_target=not own and not keys_may_repeat(target, keys))
        return self._write(part, after, touched, batch)
