"""Centroid clustering (k-means on integer vectors) with Ptolemaic pivots.

Method. Every component x becomes the integer floor(scale * x), so distances, sums and centroids are exact. A few kept vectors serve as
pivots for all rounds; each vector's squared distances to them are computed once and cached in the written index. For a vector o, a centroid
q and a fixed pair of pivots p, s, Ptolemy's inequality gives

    d(o, q) >= |d(o, p) d(q, s) - d(o, s) d(q, p)| / d(p, s),

so a round needs the distances of the few centroids to the pivots, and no vector, to bound all distances from below. The centroid of
least bound is measured first; of the others only those whose bound does not rule them out are. Bounds are rounded down by far more than
doubles can err, so a centroid that is nearest, or as near as the nearest, is never ruled out, and what is measured is measured in integers.

A round is one pass over the index. Each task adds up its vectors by cluster, and Spark adds up the tasks' sums by (cluster, component),
so a cluster that holds most vectors is no hot spot; the driver sees ``k * length`` sums.

Defined results: a vector that is null, of another length, or has a null or non-finite component is left out; a row with a null id is
clustered but never starts a cluster; rows that repeat an id are clustered each by itself, and of equal hashes the smaller vector comes
first; fewer vectors than ``k`` start as many clusters; ties go to the smaller cluster number; a cluster without vectors keeps its
centroid; no rows give no rows; other columns are not read. A scaled component beyond +-2**27 is refused with an error, because its
squared distances leave the range of a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import written

CLUSTERS, ROUNDS, LENGTH, SCALE = 16, 3, 64, 64.0
#: Each pivot is paired with so many of the others, those farthest from it.
PARTNERS = 2
#: What a bound is rounded down by: some thousand times the error of the few operations on doubles that make it.
SLACK = 2.0**-40
LARGEST = 1 << 27
ASSIGNED_SCHEMA = "vec_id bigint, cluster int, distance bigint, measured int"


def scaled(vector: Column, scale: float = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column, length: int) -> Column:
    """Vectors that take part: of the given length, with finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == length) & finite, F.lit(False))


def start_order(key: Column) -> Column:
    return F.sha2(F.concat(F.lit("1:"), key.cast("string")), 256)


def pivot_pairs(pivots: np.ndarray, partners: int = PARTNERS) -> list[tuple[int, int]]:
    """The fixed pairs: each pivot with those farthest from it."""
    distance = squared(pivots, pivots)
    pairs = {
        (min(i, j), max(i, j))
        for i in range(len(pivots))
        for j in np.argsort(-distance[i], kind="stable")[:partners].tolist()
        if distance[i, j] > 0
    }
    return sorted(pairs)


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors to a few points."""
    out = np.empty((len(vectors), len(points)), np.int64)
    for i, point in enumerate(points):
        out[:, i] = ((vectors - point) ** 2).sum(axis=1)
    return out


def lower_bounds(to_pivots: np.ndarray, centroids_to_pivots: np.ndarray, between: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
    """For each vector and centroid a squared distance that theirs is certainly not below. Arguments are exact squared distances."""
    own, theirs, apart = np.sqrt(to_pivots.astype(float)), np.sqrt(centroids_to_pivots.astype(float)), np.sqrt(between.astype(float))
    best = np.zeros((len(own), len(theirs)))
    for p, s in pairs:
        one, other = own[:, p, None] * theirs[None, :, s], own[:, s, None] * theirs[None, :, p]
        np.maximum(best, (np.abs(one - other) - (one + other) * SLACK) / apart[p, s], out=best)
    return best * best * (1 - SLACK)


@dataclass
class Assigner:
    """Finds the nearest centroid of vectors by their cached distances to the pivots."""

    pivots: np.ndarray
    centroids: np.ndarray

    def __post_init__(self):
        self.pairs = pivot_pairs(self.pivots)
        self.between, self.theirs = squared(self.pivots, self.pivots), squared(self.centroids, self.pivots)

    def __call__(self, vectors: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster and exact squared distance of each vector, and how many centroids were measured for it."""
        bounds = lower_bounds(to_pivots, self.theirs, self.between, self.pairs)
        guess = bounds.argmin(axis=1)
        cluster, measured = guess.copy(), np.ones(len(vectors), np.int64)
        distance = ((vectors - self.centroids[guess]) ** 2).sum(axis=1)
        for number, centroid in enumerate(self.centroids):
            open_ = np.flatnonzero((guess != number) & (bounds[:, number] <= distance * (1 + SLACK)))
            exact = ((vectors[open_] - centroid) ** 2).sum(axis=1)
            measured[open_] += 1
            nearer = (exact < distance[open_]) | ((exact == distance[open_]) & (number < cluster[open_]))
            cluster[open_[nearer]], distance[open_[nearer]] = number, exact[nearer]
        return cluster, distance, measured


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def pivot_index(vectors: DataFrame, pivots: np.ndarray, length: int) -> DataFrame:
    """``vec_id, vector, to_pivots``: what every round reads, with the squared distances to the pivots. Written once."""
    schema = "vec_id bigint, vector array<int>, to_pivots array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column(1), length)
            if len(own) and np.abs(own).max() > LARGEST:
                raise ValueError(f"a scaled component is beyond {LARGEST}, where squared distances are no longer exact")
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))
                for x, kind in ((own, pa.int32()), (squared(own, pivots), pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["vec_id", "vector", "to_pivots"])

    return written(vectors.select("vec_id", "vector").mapInArrow(run, schema), "pivot-index")


def moved(index: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors, componentwise."""
    k, length = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign, sums, counts = Assigner(pivots, centroids), np.zeros((k, length), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            own = matrix(batch.column(0), length)
            cluster, _, _ = assign(own, matrix(batch.column(1), len(pivots)))
            counts += np.bincount(cluster, minlength=k)
            for number in np.unique(cluster):
                sums[number] += own[cluster == number].sum(axis=0)
        held = np.flatnonzero(counts)
        columns = [np.repeat(held, length), np.tile(np.arange(length), len(held)), sums[held].ravel(), np.repeat(counts[held], length)]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "place", "total", "n"])

    partial = index.select("vector", "to_pivots").mapInArrow(run, "cluster int, place int, total bigint, n bigint")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    out = centroids.copy()
    for row in partial.groupBy("cluster", "place").agg(exact, F.sum("n").alias("n")).collect():
        out[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return out


def assigned(index: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance, measured``: the nearest centroid of each vector and how many were measured to find it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(pivots, centroids)
        for batch in batches:
            found = assign(matrix(batch.column(1), centroids.shape[1]), matrix(batch.column(2), len(pivots)))
            arrays = [pa.array(c, t) for c, t in zip(found, (pa.int32(), pa.int64(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["vec_id", "cluster", "distance", "measured"])

    return index.mapInArrow(run, ASSIGNED_SCHEMA)


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH, scale: float = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance, measured`` of every vector that takes part, and the final centroids, one a row.

    Clusters start as the ``k`` vectors of least hash of their id, which also serve as the pivots: in the first round bounds are distances.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = rows.where(usable(F.col("vector"), length)).withColumn("vector", scaled(F.col("vector"), scale))
    named = rows.where("vec_id is not null").select(start_order(F.col("vec_id")).alias("h"), "vector")
    first = named.orderBy("h", "vector").limit(k).collect()
    if not first:
        return rows.select("vec_id").limit(0).selectExpr("vec_id", "0 as cluster", "0L as distance", "0 as measured"), np.empty((0, length), np.int64)
    centroids = np.array([r["vector"] for r in first], np.int64)
    pivots = np.unique(centroids, axis=0)
    index = pivot_index(rows, pivots, length)
    for _ in range(rounds):
        centroids = moved(index, pivots, centroids)
    return written(assigned(index, pivots, centroids), "clusters"), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to the rows of ``cluster``; at most one row a centroid is broadcast."""
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = [(n, s, sum(sums.values()), digest[n]) for n, s in sums.items()]
    names = found.sparkSession.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
