from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from snapmart.llm import centroid_clusters as cc
from snapmart.llm.queries import ORACLE, op11_centroid_clusters

SIZE = 64


def restated(rows, k, rounds, seed=2):
    """[(id, cluster, distance)], centroids: by comparing everything with everything in Python's integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == SIZE and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        places = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), p in zip(kept, places) if p == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, cluster int")


def rows_of(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, SIZE))
    return [(i, [float(np.float32(x)) for x in centres[i % 7] + rng.normal(size=SIZE) * 0.3]) for i in range(n)]


def check(spark, rows, k, rounds):
    want, centroids = restated(rows, k, rounds)
    got = cc.cluster(vectors(spark, rows), k=k, rounds=rounds).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=order) == sorted(want, key=order)
    for r in got:
        own = [d for _, c, d in want if c == r["cluster"]]
        assert (r["cluster_inertia"], r["inertia"]) == (sum(own), sum(d for _, _, d in want))
        assert r["centroid"] == centroids[r["cluster"]]


def test_against_integers(spark):
    check(spark, rows_of(200), 12, 5)


def test_edge_rows(spark):
    """Null, short, long and non-finite vectors, null and repeated ids, hot copies, all-equal ties, huge components."""
    good = rows_of(30)
    odd = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [math.nan] * SIZE),
           (106, [math.inf] + [0.0] * 63), (None, [0.5] * SIZE), (None, [0.25] * SIZE), (3, good[3][1]), (107, [-0.001] * SIZE)]
    check(spark, [*good, *odd, *[(200 + i, [0.1] * SIZE) for i in range(60)]], 10, 3)
    check(spark, [(i, [0.0] * SIZE) for i in range(6)], 4, 2)
    check(spark, [(1, [300_000.5] * SIZE), (2, [-300_000.25] * SIZE), (3, [0.0] * SIZE)], 2, 2)


def test_components_beyond_the_bound_are_dropped(spark):
    assert cc.cluster(vectors(spark, [(1, [1e30] * SIZE), (2, [0.0] * SIZE)]), k=2, rounds=1).count() == 1


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_kept(spark, rows):
    got = cc.cluster(vectors(spark, rows))
    assert got.count() == 0
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_the_bound_spares_comparisons(spark):
    """The filter is a lower bound, and removes most centroids where the variance lies on few axes."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(500, SIZE)) * np.r_[np.full(6, 400), np.full(58, 5)]).astype(np.int64)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :16]
    rotation = cc.Rotation(x.mean(axis=0), axes)
    lead, centroids = rotation.leading(x), x[:40]
    low = ((lead[:, None] - rotation.leading(centroids)) ** 2).sum(axis=2)
    exact = ((x[:, None] - centroids) ** 2).sum(axis=2)
    assert (low <= exact + 1e-3).all() and (low <= exact.min(axis=1)[:, None]).mean() < 0.2
    nearest, best = cc.assign(x, lead, centroids, rotation)
    assert (nearest == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    got = op11_centroid_clusters(spark, folder)
    want = con.execute(ORACLE["op11_centroid_clusters"])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
