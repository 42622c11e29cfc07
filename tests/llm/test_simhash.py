from __future__ import annotations

import random

from snapmart.llm import simhash
from snapmart.llm.components import connected_components
from snapmart.llm.queries import op9_simhash
from tests.conftest import SF_SMALL
from tests.llm.brute import components, documents, edge_rows, fingerprint


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = components(prints)
    first: dict[int, int | None] = {}
    for (i, _), p in zip(rows, prints):
        known = first.get(root[p])
        first[root[p]] = i if known is None else known if i is None else min(known, i)
    return sorted((i if i is not None else -1, f"{p:016x}", first[root[p]]) for (i, _), p in zip(rows, prints))


def found(frame):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"]) for r in frame.collect())


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def test_edge_rows(spark):
    rows = edge_rows()
    assert found(simhash.near_duplicates(documents(spark, rows, extra=True))) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_first(documents(spark, [])).count() == 0


def test_links_of_short_and_long_lists_join_the_same_components(spark):
    draw = random.Random(8)
    prints = set()
    for _ in range(30):  # chains and dense groups of fingerprints a few bits apart
        here = draw.getrandbits(64)
        for _ in range(draw.choice((1, 3, 40))):
            prints.add(here)
            here ^= 1 << draw.randrange(64)
            if draw.random() < 0.5:
                here ^= 1 << draw.randrange(64)
    root = components(prints)
    groups = sorted(sorted(p for p in prints if root[p] == r) for r in set(root.values()))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for longest in (1, 4, 1000):
        links = simhash.links(frame, longest)
        for row in links.collect():
            assert bin((row["a"] ^ row["b"]) & (1 << 64) - 1).count("1") <= 2
        by_root: dict[int, list[int]] = {}
        linked = {r["node"]: r["root"] for r in connected_components(links).collect()}
        for p in prints:
            by_root.setdefault(linked.get(signed(p), signed(p)), []).append(p)
        assert sorted(sorted(v) for v in by_root.values()) == groups


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(10, 40)]
    got = connected_components(spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (41, 5), (5, 41)], "a long, b long"))
    assert {r["node"]: r["root"] for r in got.collect()} == {i: 100 for i in range(100, 161)} | {i: 5 for i in (5, 41, *range(10, 40))}


def test_keep_first(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(9, text), (3, text), (3, text), (None, text), (4, "other words entirely here"), (None, "only without an id"), (None, "only without an id")]
    kept = simhash.keep_first(documents(spark, rows, extra=True))
    assert sorted((r["doc_id"] or -1, r["text"][:5]) for r in kept.collect()) == [(-1, "only "), (3, "word0"), (4, "other")]
    assert kept.columns == documents(spark, rows, extra=True).columns


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op9_simhash(spark, SF_SMALL)) == expected(rows)


def test_names_of_the_users_columns_are_kept(spark):
    from pyspark.sql import functions as F

    names = ["__id", "__key", "first_id", "first_text_key", "id", "text_key", "fp"]
    docs = documents(spark, [(1, "a b c d"), (2, "a b c d"), (3, "other words here"), (3, "other words here"), (None, None)]).select(
        "*", *(F.lit(c).alias(c) for c in names))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["__id"], r["first_id"]) for r in kept.collect()) == [(0, "__id", "first_id"), (1, "__id", "first_id"), (3, "__id", "first_id")]
