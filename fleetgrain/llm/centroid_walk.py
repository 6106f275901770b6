"""Centroid clustering of integer vectors, the nearest centroid found by the threshold algorithm.

Every dimension keeps its centroids sorted by value. A vector walks each of
these lists outward from its own value, one centroid further in every round, on
the side that is nearer. A centroid met for the first time in any list gets its
exact distance. What no list has met yet is at least as far as all frontiers
together: the sum over dimensions of the squared gap last met. The walk ends
when that sum is strictly greater than the best exact distance, so a centroid
at the same distance is still met and ties go to the smaller number. Vectors of
a batch walk side by side in arrays; those that are done drop out.

Clustering. Vectors with `dims` components, none null or non-finite, become
integers floor(scale * x). The first centroids are the vectors whose hashes are
smallest. A round is one pass: tasks assign their vectors and sum them per
centroid, Spark adds the sums up, and the driver replaces centroids by floors of
exact means. What is broadcast, summed and collected is centroids times
dimensions, whatever the number of vectors, and no vector is ever shuffled, so
equal vectors, however many, gather nowhere.

Defined cases: other vectors are left out; components beyond `LIMIT` are held
at it, so that squared distances fit 64 bits; a null vec_id has no hash and
comes last among the first centroids; equal hashes are ordered by the vector;
repeated rows are vectors of their own; with fewer vectors than centroids there
are as many centroids as vectors; an empty centroid stays as it is; without
vectors there are no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.session import cut_lineage

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
LIMIT = 1 << 27


class SortedCentroids:
    """The centroids, and for each dimension their order by value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid, the smaller number on ties."""
        n, dims = vectors.shape
        k = len(self.centroids)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, -1)
        # the next place of each list to the right, and to the left
        right = np.empty((n, dims), np.int64)
        for d in range(dims):
            right[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        left = right - 1
        walking = np.arange(n)
        seen = np.zeros((n, k), bool)
        column = np.arange(dims)
        far = np.iinfo(np.int64).max
        for _ in range(k):
            x, lo, hi = vectors[walking], left[walking], right[walking]
            below = np.where(lo >= 0, x - self.values[np.maximum(lo, 0), column], far)
            above = np.where(hi < k, self.values[np.minimum(hi, k - 1), column] - x, far)
            down = below <= above
            met = self.order[np.where(down, np.maximum(lo, 0), np.minimum(hi, k - 1)), column]
            left[walking] -= down
            right[walking] += ~down
            fresh = np.zeros((len(walking), k), bool)
            fresh[np.arange(len(walking))[:, None], met] = True
            fresh &= ~seen[walking]
            seen[walking] |= fresh
            for c in np.flatnonzero(fresh.any(axis=0)):
                rows = np.flatnonzero(fresh[:, c])
                exact = ((x[rows] - self.centroids[c]) ** 2).sum(axis=1)
                of = walking[rows]
                nearer = (exact < best[of]) | (exact == best[of]) & (c < number[of])
                best[of[nearer]], number[of[nearer]] = exact[nearer], c
            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            walking = walking[frontier <= best[walking]]
            if not len(walking):
                break
        return number, best


def vectors(table: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the rows whose embedding has `dims` finite components, as integers."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(
        "embedding",
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long"),
    )
    return (
        table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where((F.size("embedding") == dims) & whole)
        .select("vec_id", scaled.alias("v"))
    )


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("v"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    shared = kept.sparkSession.sparkContext.broadcast(centroids)
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def kernel(batches):
        lists = SortedCentroids(shared.value)
        for batch in batches:
            if batch.num_rows:
                number, distance = lists.nearest(_matrix(batch, shared.value.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(distance)], schema=schema)

    return kept.select("vec_id", "v").mapInArrow(kernel, "vec_id long, cluster int, distance long")


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means of the vectors nearest to each."""
    shared = kept.sparkSession.sparkContext.broadcast(centroids)
    schema = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    def kernel(batches):
        lists = SortedCentroids(shared.value)
        k, dims = shared.value.shape
        totals, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch, dims)
                number, _ = lists.nearest(matrix)
                for c in np.unique(number):
                    totals[c] += matrix[number == c].sum(axis=0)
                n += np.bincount(number, minlength=k)
        held = np.repeat(np.flatnonzero(n), dims)
        dim = np.tile(np.arange(dims), len(held) // dims)
        columns = [held.astype(np.int32), dim.astype(np.int32), totals[held, dim], n[held]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    summed = (
        kept.select("v")
        .mapInArrow(kernel, "cluster int, dim int, total long, n long")
        .groupBy("cluster", "dim")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    )
    after = centroids.copy()
    for row in summed.collect():  # centroids times dimensions at most
        after[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    return after


def first_centroids(kept: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `1:<vec_id>`, in that order."""
    hashed = kept.select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("hash"), "v")
    rows = hashed.orderBy(F.asc_nulls_last("hash"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cluster(
    table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector; and the centroids."""
    kept = cut_lineage(vectors(table, dims, scale))
    centroids = first_centroids(kept, k)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    spark = table.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], schema), centroids
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    assigned = cut_lineage(assign(kept, centroids))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("cluster_inertia"))
    found = {r["cluster"]: int(r["cluster_inertia"]) for r in sums.collect()}  # one row per centroid
    facts = [
        (c, of, sum(found.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, of in found.items()
    ]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(facts), "cluster")  # one row per centroid
    return joined.select(*[c.split()[0] for c in schema.split(", ")]), centroids
