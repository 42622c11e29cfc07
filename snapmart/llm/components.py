"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the component's smallest node.

    Large-star and small-star steps (Kiveris and others 2014) until nothing changes:
    every node points its larger neighbours, then itself and its smaller ones,
    at the smallest node it knows. The number of rounds grows with the logarithm of the
    longest chain. Each round is a staged table, so a lost executor costs at
    most one round; nothing but a count and a checksum reaches the driver.

    Links may repeat, run either way or join a node to itself; those with a null
    end are ignored. No links give an empty table.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = stage(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(high.alias("u"), low.alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionAll(smallest.select("u", F.col("m").alias("v"))).distinct(), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0
