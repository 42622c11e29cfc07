"""Centroid clustering in whole numbers, with a filter in rotated coordinates.

The vectors' covariance gives a rotation whose leading axes carry most of the variance. A
vector keeps its leading rotated coordinates and the norm of the rest. For a vector and a centroid, the
squared distance of the leading coordinates plus the squared difference of the two norms never
exceeds the squared distance. So each vector is compared exactly with the centroid of the lowest bound
first, and then only with those whose bound isn't above what it found. These comparisons are in
64-bit integers, so rounding in the bounds can cost time but never changes a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from snapmart.llm.common import stage

SCALE = 256
#: Leading coordinates that a vector keeps.
LEADING = 16
#: Components whose squared distances always fit 64 bits.
MAX_COMPONENT = 1 << 27
#: Vectors compared at once.
BLOCK = 1024


def whole_numbers(vectors: DataFrame, size: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x): vectors with exactly ``size`` finite components, each x as floor(scale * x).

    Dropped: null vectors, those of another size, with a null or non-finite component, or
    with one beyond MAX_COMPONENT after scaling, whose squared distances wouldn't fit a long.
    """
    def fits(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) <= MAX_COMPONENT)

    values = F.col(vec_col).cast("array<double>")
    kept = vectors.select(F.col(id_col).alias("id"), values.alias("v")).where((F.size("v") == size) & F.forall("v", fits))
    return kept.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hexadecimal sha256 of ``<seed>:<id>``; ties by components, a null id as ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.select("x", F.sha2(name, 256).alias("h")).orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def _matrix(column: pa.Array, size: int, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), size)


class Rotation:
    """Leading axes of the covariance; ``leading`` gives coordinates on them and the norm of what is left."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray) -> None:
        self.mean, self.axes = mean, axes

    def leading(self, x: np.ndarray) -> np.ndarray:
        centred = x - self.mean
        inside = centred @ self.axes
        rest = np.sqrt(((centred - inside @ self.axes.T) ** 2).sum(axis=1))
        return np.column_stack((inside, rest))


def fit_rotation(kept: DataFrame, size: int, leading: int = LEADING) -> Rotation:
    """From sums over all vectors. One row for each entry of the covariance reaches the driver."""
    upper = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch.column(0), size, np.float64)
            n, first, second = n + len(x), first + x.sum(axis=0), second + x.T @ x
        if n:
            values = np.concatenate(([n], first, second[upper]))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

    rows = kept.select("x").mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(1 + size + len(upper[0]))
    for row in rows:
        values[row["at"]] = row["value"]
    n = max(values[0], 1)
    mean, second = values[1 : 1 + size] / n, np.zeros((size, size))
    second[upper] = values[1 + size :] / n
    covariance = second + np.triu(second, 1).T - np.outer(mean, mean)
    return Rotation(mean, np.linalg.eigh(covariance)[1][:, ::-1][:, :leading])


def assign(x: np.ndarray, lead: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; ties go to the smaller number."""
    own = rotation.leading(centroids.astype(np.float64))
    nearest, best = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=np.int64)
    for at in range(0, len(x), BLOCK):
        here, low = x[at : at + BLOCK], ((lead[at : at + BLOCK, None] - own) ** 2).sum(axis=2)
        slack = 1e-6 + 1e-9 * ((lead[at : at + BLOCK] ** 2).sum(axis=1)[:, None] + (own**2).sum(axis=1))
        guess = low.argmin(axis=1)
        found = ((here - centroids[guess]) ** 2).sum(axis=1)
        survives = low - slack <= found[:, None]
        survives[np.arange(len(here)), guess] = False
        for number in np.flatnonzero(survives.any(axis=0)):
            rows = np.flatnonzero(survives[:, number])
            exact = ((here[rows] - centroids[number]) ** 2).sum(axis=1)
            closer = (exact < found[rows]) | ((exact == found[rows]) & (number < guess[rows]))
            found[rows[closer]], guess[rows[closer]] = exact[closer], number
        nearest[at : at + BLOCK], best[at : at + BLOCK] = guess, found
    return nearest, best


def _round(vectors: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """The centroids after one round; a task sends on one row for each of its clusters."""
    k, size = centroids.shape
    width = rotation.axes.shape[1] + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), size, np.int64)
            nearest, _ = assign(x, _matrix(batch.column(1), width, np.float64), centroids, rotation)
            n += np.bincount(nearest, minlength=k)
            np.add.at(total, nearest, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(n[some]), pa.array(total[some].tolist(), type=pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    made = vectors.select("x", "lead").mapInArrow(sums, "cluster long, n long, total array<long>")
    rows = made.groupBy("cluster").agg(F.sum("n"), *(F.sum(F.col("total")[i]) for i in range(size))).collect()
    moved = centroids.copy()
    for cluster, n, *total in rows:
        moved[cluster] = [t // n for t in total]
    return moved


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    seed: int = 2,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    leading: int = LEADING,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of each vector that ``whole_numbers`` keeps.

    The first centroids are those of ``first_centroids``, fewer than ``k`` where fewer vectors are kept. Each
    round assigns every vector to its nearest centroid and puts every non-empty centroid at
    the floor of its vectors' mean; then the vectors are assigned once more. ``distance`` is squared, ``cluster_inertia``
    and ``inertia`` sum it over the cluster and over all (null beyond a long), ``centroid`` is the final one.

    Repeated rows keep a row each and count each; extra columns are ignored; a table without a
    vector to keep gives an empty result. Vectors never leave their task: a round shuffles ``k`` rows of sums
    a task at most, and ``k`` of them reach the driver. Equal vectors in any number thus cost no more than others.
    """
    made = StructType([
        StructField(id_col, vectors.schema[id_col].dataType), StructField("cluster", LongType()), StructField("distance", LongType())])
    kept = stage(whole_numbers(vectors, size, id_col, vec_col), "vectors")
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return kept.select(
            F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
            F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.col("x").cast("array<long>").alias("centroid"))
    rotation = fit_rotation(kept, size, leading)
    width = leading + 1

    def rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = rotation.leading(_matrix(batch.column(1), size, np.float64))
            lists = pa.ListArray.from_arrays(np.arange(0, lead.size + 1, width, dtype=np.int32), lead.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "x", "lead"])

    turned = stage(kept.mapInArrow(rotated, StructType([*kept.schema.fields]).add("lead", ArrayType(DoubleType()))), "rotated")
    for _ in range(rounds):
        centroids = _round(turned, centroids, rotation)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, best = assign(_matrix(batch.column(1), size, np.int64), _matrix(batch.column(2), width, np.float64), centroids, rotation)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nearest), pa.array(best)], names=made.names)

    placed = stage(turned.mapInArrow(last, made), "clusters")
    sums = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}

    def fitting(value: int) -> Column:
        return F.lit(value if value < 1 << 63 else None).cast("long")

    at = F.col("cluster").cast("int")
    return placed.select(
        id_col, at.alias("cluster"), "distance",
        F.array(*(fitting(sums.get(i, 0)) for i in range(len(centroids))))[at].alias("cluster_inertia"),
        fitting(sum(sums.values())).alias("inertia"),
        F.array(*(F.array(*map(F.lit, c)).cast("array<long>") for c in centroids.tolist()))[at].alias("centroid"))


def digest(centroid: np.ndarray) -> str:
    """sha256 of a centroid's components as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
