"""Centroid clustering whose assignment walks per-dimension centroid lists (threshold algorithm)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import stored

LARGEST = float(1 << 27)  # of a component after scaling: squared distances and their sums then fit 64 bits
_ROWS = 1024  # vectors walked together


class CentroidLists:
    """For each dimension the centroids in ascending order of their component, walked outward from a vector's value.

    Each step takes, in every dimension, the nearer of the next centroid below
    and above; centroids met for the first time get their exact distance.  Any
    centroid not met yet is at least as far in each dimension as the frontier
    there, so a vector is done when the sum of the squared frontier distances
    is strictly above its best distance: nothing unmet can be nearer or equal.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.centroids, self.order, axis=0)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest centroid, ties to the smaller number; squared distance; number of exact distances) of each row."""
        k, dims = self.centroids.shape
        n = len(x)
        best, near = np.full(n, np.iinfo(np.int64).max), np.zeros(n, dtype=np.int64)
        met = np.zeros((n, k), dtype=bool)
        high = np.stack([np.searchsorted(self.sorted[:, d], x[:, d]) for d in range(dims)], axis=1).reshape(n, dims)
        low = high - 1
        live = np.arange(n)
        dim = np.arange(dims)
        far = np.int64(1 << 31)
        for _ in range(k):
            v, lo, hi = x[live], low[live], high[live]
            down = np.where(lo >= 0, v - self.sorted[np.maximum(lo, 0), dim], far)
            up = np.where(hi < k, self.sorted[np.minimum(hi, k - 1), dim] - v, far)
            below = down <= up
            taken = self.order[np.where(below, lo, np.minimum(hi, k - 1)), dim]
            low[live], high[live] = lo - below, hi + ~below
            new = np.zeros((len(live), k), dtype=bool)
            new[np.arange(len(live))[:, None], taken] = True
            new &= ~met[live]
            met[live] |= new
            for c in np.flatnonzero(new.any(axis=0)).tolist():  # ascending numbers, so a tie keeps the smaller within a step
                at = live[new[:, c]]
                gap = x[at] - self.centroids[c]
                d = np.einsum("ij,ij->i", gap, gap)
                better = (d < best[at]) | ((d == best[at]) & (c < near[at]))
                best[at[better]], near[at[better]] = d[better], c
            frontier = np.minimum(down, up)  # the distance just reached bounds all that is left in the dimension
            live = live[np.einsum("ij,ij->i", frontier, frontier) <= best[live]]
            if not len(live):
                break
        return near, best, met.sum(axis=1)


def usable(column: str, dims: int) -> Column:
    """Vectors with exactly ``dims`` components, none null or non-finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(column).isNotNull() & (F.size(column) == dims) & ~bad


def integer_vectors(vectors: DataFrame, dims: int = 64, scale: int = 256, column: str = "embedding") -> DataFrame:
    """vec_id, v (array of floor(scale * x), x as double) of the usable vectors; a component of 2^27 or more raises."""
    value = F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    wide = F.exists(column, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) >= LARGEST)
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column)).filter(usable(column, dims))
            .select("vec_id", F.when(wide, F.raise_error(F.lit("a vector component reaches 2^27 after scaling")))
                    .otherwise(value).cast("array<long>").alias("v")))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id`` in that order, equal ones by components; a null id is an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def _rows(batch: pa.RecordBatch, column: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each cluster's vectors, exactly; an empty cluster keeps its centroid.

    A task adds up its vectors and sends a number per cluster and dimension
    at most, so neither a large cluster nor many vectors meet in one task;
    the driver gets clusters x dimensions sums.
    """
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, x in _rows(batch, 0, dims):
                near = lists.assign(x)[0]
                np.add.at(total, near, x)
                count += np.bincount(near, minlength=k)
        c = np.repeat(np.flatnonzero(count), dims)
        d = np.tile(np.arange(dims), len(c) // dims)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(total[c, d]), pa.array(count[c])],
                                         names=["c", "d", "s", "n"])

    parts = vectors.select("v").mapInArrow(add, "c long, d long, s long, n long")
    exact = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    out = centroids.copy()
    for r in parts.groupBy("c", "d").agg(exact("s"), exact("n")).collect():
        out[r["c"], r["d"]] = int(r["s"]) // int(r["n"])
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared), compared (exact distances computed) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        for batch in batches:
            for part, x in _rows(batch, 1, centroids.shape[1]):
                near, best, seen = lists.assign(x)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(near, pa.int32()), pa.array(best), pa.array(seen)],
                                                 names=["vec_id", "cluster", "distance", "compared"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long, compared long")


def fit(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> np.ndarray:
    """Centroids after ``rounds`` rounds over integer ``vectors`` (vec_id, v); fewer than ``k`` where there are fewer vectors."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(vectors, centroids)
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, compared, cluster_inertia, inertia, centroid_sha256 of every usable vector of ``embeddings``.

    Vectors of another length, null ones and those with null or non-finite
    components are left out.  Repeated rows are rows of their own.  No usable
    vectors give no rows.  The integer vectors are written once, as each
    round reads them; ``k`` x ``dims`` numbers go to the tasks and back.
    """
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, dims, scale), "vectors")
    centroids = fit(rows, k, rounds, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, compared long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    near = stored(assigned(rows, centroids), "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    named = [(c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c in sorted(sums)]
    totals = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return near.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid_sha256")
