"""SimHash near-duplicates through an inverted index of byte positions.

A document's 64-bit fingerprint is eight bytes. Two fingerprints that differ in at
most two bits differ in at most two bytes, so they share at least six of their
eight positional bytes; and of four pairs of neighbouring bytes they share at
least two. The index therefore lists every fingerprint under each of the six
choices of two pairs. Fingerprints that meet there have their shared positional
bytes tallied; pairs that reach six are verified by counting bits.

A list of the index can be long where many copies differ a little. Lists beyond
MAX_LIST aren't paired up: their fingerprints are listed under themselves and
their 64 one-bit neighbours instead. Two fingerprints are at most two bits apart
if and only if they share such an entry, and no entry can have more than 65
distinct members, so this is exact and linear. Either way no text, and no group of
copies, is ever compared with itself: equal fingerprints are one node.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import free_name, map_texts, stage
from snapmart.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Lists of the index with more fingerprints are resolved by one-bit neighbours.
MAX_LIST = 48
#: Positional bytes that two fingerprints within MAX_BITS share at least.
LEAST_SHARED = 8 - MAX_BITS


def fingerprint(raw: bytes, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a UTF-8 text."""
    parts = raw.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not parts:
        return 0
    if len(parts) <= words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*(parts[i:] for i in range(words)))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64, count=len(shingles))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def _kernel(texts: list[str]) -> dict[str, list[int]]:
    found = np.array([fingerprint(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=np.uint64)
    return {"fp": found.view(np.int64).tolist()}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, fp) for each row; fp is the fingerprint's bits as a signed long, text_key a hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return map_texts(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")), _kernel, "fp long")


def shared_bytes(x: Column, y: Column) -> Column:
    """The number of positions at which two fingerprints hold the same byte."""
    differ = x.bitwiseXOR(y)
    return sum(
        (F.when(differ.bitwiseAND(F.lit(_signed(0xFF << 8 * i))) == 0, 1).otherwise(0) for i in range(8)), F.lit(0))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _index(prints: DataFrame) -> DataFrame:
    """(slot, entry, fp): each fingerprint under its six choices of two pairs of bytes."""
    entries = [
        F.struct(F.lit(slot).alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(0xFFFF << 16 * i | 0xFFFF << 16 * j))).alias("entry"))
        for slot, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return prints.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.slot", "e.entry", "fp")


def links(prints: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """(a, b): links between distinct fingerprints at most MAX_BITS bits apart.

    All links of lists up to ``max_list``; of longer ones, for each shared
    neighbour, those of its members to the smallest: the same components.
    """
    index = _index(prints)
    lengths = index.groupBy("slot", "entry").agg(F.count("*").alias("n")).where("n > 1")
    listed = index.join(lengths, ["slot", "entry"])
    short = listed.where(F.col("n") <= max_list).groupBy("slot", "entry").agg(F.collect_list("fp").alias("fps"))

    def linked(x: Column) -> Column:
        others = F.filter("fps", lambda y: (y > x) & (shared_bytes(x, y) >= LEAST_SHARED) & (F.bit_count(x.bitwiseXOR(y)) <= MAX_BITS))
        return F.transform(others, lambda y: F.struct(x.alias("a"), y.alias("b")))

    pairs = short.select(F.explode(F.flatten(F.transform("fps", linked))).alias("p")).select("p.a", "p.b")
    crowded = listed.where(F.col("n") > max_list).select("fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    entries = crowded.select("fp", F.explode(near).alias("entry")).groupBy("entry").agg(F.collect_set("fp").alias("fps"))
    stars = (
        entries.where(F.size("fps") > 1).select("fps", F.array_min("fps").alias("a"))
        .select("a", F.explode("fps").alias("b")).where("b != a")
    )
    return pairs.unionAll(stars).distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, max_list: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_key, fp) of all rows, staged, and (fp, first) with the first row of each fingerprint's component.

    ``first`` is (no_id, id, text_key): rows with an id come before those without.
    """
    prints = stage(fingerprints(docs, id_col, text_col), "simhash")
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    classes = stage(prints.groupBy("fp").agg(F.min(row).alias("first")), "simhash-classes")
    roots = connected_components(links(classes.select("fp"), max_list))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    component = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return prints, rooted.select("fp", "root").join(component, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_list: int = MAX_LIST) -> DataFrame:
    """(id, fingerprint, component_id) for each row of ``docs``.

    ``fingerprint`` is 16 lowercase hexadecimal digits, ``component_id`` the smallest
    id reachable over links between fingerprints at most MAX_BITS bits apart. A null
    or empty text, and one of blanks, has fingerprint 0 and is linked like any
    other. A null id never is the smallest; where all ids of a component are
    null, so is ``component_id``. Repeated rows keep a row each; extra columns
    are ignored; an empty table gives an empty one.

    Fingerprints are staged first; then only distinct ones travel. The last
    join can have a fingerprint that a third of all rows share: its other side has
    one row for each fingerprint, so Spark can split it.
    """
    prints, firsts = _grouped(docs, id_col, text_col, max_list)
    return prints.join(firsts, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_list: int = MAX_LIST) -> DataFrame:
    """One row of ``docs`` for each component, with its smallest id; columns as given.

    Rows without an id stay only where no row of their component has one. Of rows
    that agree in id and text one stays.
    """
    prints, firsts = _grouped(docs, id_col, text_col, max_list)
    own_id, own_key = free_name(docs, "first_id"), free_name(docs, "first_text_key")
    kept = firsts.select(F.col("first.id").alias(own_id), F.col("first.text_key").alias(own_key))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(own_key))
    stays = docs.join(kept, same, "left_semi")
    repeated = (
        prints.groupBy("id", "text_key").agg(F.count("*").alias("n")).where("n > 1")
        .join(kept, F.col("id").eqNullSafe(F.col(own_id)) & (F.col("text_key") == F.col(own_key)), "left_semi"))
    return stays if repeated.isEmpty() else stays.dropDuplicates([id_col, text_col])
