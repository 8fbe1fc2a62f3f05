"""Exact top-k search by a Voronoi kNN join on integer vectors and inner products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.llm.common import stored

LARGEST = float((1 << 63) - 1024)


@dataclass(frozen=True)
class Grid:
    """Parameters: pivots (a bounded sample of the vectors), query groups, rows compared in one task, scale."""

    pivots: int = 64
    groups: int = 8
    queries_together: int = 4096
    data_together: int = 50_000
    scale: int = 256
    seed: int = 3


def _matrix(col: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of list values, padded with zeros to ``dim``."""
    size = np.asarray(pc.list_value_length(col), dtype=np.int64)
    out = np.zeros((len(col), dim))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = np.floor(scale * flat)
    return out


def _stack(col: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype="<f8").reshape(len(col), dim)


def _assign(pivots: np.ndarray, dim: int, scale: int):
    """Each vector with its nearest pivot and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(3), dim, scale)
                d = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots])
                cell = d.argmin(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(cell, pa.int32()), pa.array(d[cell, np.arange(len(x))]),
                     pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary())],
                    names=["row", "vec_id", "is_query", "cell", "dist", "vec"])

    return run


def _query_summary(pivots: np.ndarray):
    """Per task and query cell: the range of scores against each pivot, and the largest norm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = np.full((len(pivots), len(pivots)), -np.inf)
        low, norm = -high, np.zeros(len(pivots))
        for batch in batches:
            if batch.num_rows:
                cell = batch.column(0).to_numpy()
                q = _stack(batch.column(1), pivots.shape[1])
                s = q @ pivots.T
                np.maximum.at(high, cell, s)
                np.minimum.at(low, cell, s)
                np.maximum.at(norm, cell, np.sqrt((q ** 2).sum(axis=1)))
        i, j = np.nonzero(np.isfinite(high))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(high[i, j]),
                                          pa.array(low[i, j]), pa.array(norm[i])], names=["i", "j", "high", "low", "norm"])

    return run


def _replicate(need: np.ndarray, reach: np.ndarray, group_of: np.ndarray, groups: int):
    """Copy a vector to each query group with a cell that it may serve: high + norm * distance >= the cell's bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, dist = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            serves = dist[:, None] * reach[None, :] >= need[:, cell].T
            for g in range(groups):
                at = np.flatnonzero(serves[:, group_of == g].any(axis=1))
                if len(at):
                    some = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), g), pa.int32()), some.column(0), some.column(1), some.column(4)],
                        names=["grp", "row", "vec_id", "vec"])

    return run


def _solve(k: int, dim: int):
    """Rows sorted by (group, part, part), queries first, then data by id -> the k best of each query in the part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, q_row, q_id, q_vec, q = None, [], [], [], None
        score = ids = None

        def done() -> Iterator[pa.RecordBatch]:
            if q is not None:
                i, j = np.nonzero(score > -np.inf)
                exact = np.clip(score[i, j], -LARGEST, LARGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(q_row, dtype=np.int64)[i]), pa.array(np.asarray(q_id, dtype=np.int64)[i]),
                     pa.array(ids[i, j]), pa.array(exact)], names=["query_row", "query_id", "vec_id", "score"])

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in range(3)])
            data = batch.column(3).to_numpy(zero_copy_only=False)
            turn = np.flatnonzero(np.concatenate(([True], (np.diff(key, axis=1) != 0).any(axis=0) | (np.diff(data.astype(int)) != 0))))
            for a, b in zip(turn, [*turn[1:], batch.num_rows]):
                own = tuple(key[:, a])
                if own != now:
                    yield from done()
                    now, q_row, q_id, q_vec, q = own, [], [], [], None
                row, vec_id = batch.column(4).slice(a, b - a).to_numpy(), batch.column(5).slice(a, b - a).to_numpy()
                vec = batch.column(6).slice(a, b - a)
                if not data[a]:
                    q_row += row.tolist()
                    q_id += vec_id.tolist()
                    q_vec += vec.to_pylist()
                    continue
                if not q_row:
                    continue
                if q is None:
                    q = np.frombuffer(b"".join(q_vec), dtype="<f8").reshape(len(q_row), dim)
                    score, ids = np.full((len(q), k), -np.inf), np.zeros((len(q), k), dtype=np.int64)
                    q_vec = []
                x = _stack(vec, dim)
                for at in range(0, len(x), 2048):
                    s = q @ x[at:at + 2048].T
                    s[np.asarray(q_row)[:, None] == row[None, at:at + 2048]] = -np.inf
                    better = np.flatnonzero((s > score[:, -1:]).any(axis=1))  # equal scores lose to smaller ids seen before
                    if len(better):
                        both = np.concatenate((score[better], s[better]), axis=1)
                        name = np.concatenate((ids[better], np.broadcast_to(vec_id[at:at + 2048], (len(better), s.shape[1]))), axis=1)
                        best = np.argsort(-both, axis=1, kind="stable")[:, :k]
                        score[better] = np.take_along_axis(both, best, axis=1)
                        ids[better] = np.take_along_axis(name, best, axis=1)
        yield from done()

    return run


def _parts(df: DataFrame, size: int) -> dict[int, int]:
    """Parts per group so that each has about ``size`` rows; at most as many numbers as there are groups."""
    return {r["grp"]: max(1, -(-r["n"] // size)) for r in df.groupBy("grp").agg(F.count("row").alias("n")).collect()}


def _lookup(parts: dict[int, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for g, n in parts.items() for x in (g, n)]), F.col("grp"))


def knn_join(vectors: DataFrame, is_query: Column, k: int = 5, grid: Grid = Grid()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the largest integer inner product of each query row.

    ``vectors`` has vec_id and embedding; components become floor(scale * x)
    in double.  Every vector belongs to the cell of its nearest pivot.  From
    summaries per cell (range of the queries' scores against each pivot, their
    largest norm, the k + 1 least distances of data to their pivot) follows a
    score that each query of a cell reaches k times at least.  A data vector
    is copied to a group of query cells only if its distance to its pivot
    lets it reach that score for one of them; there, parts of queries meet
    parts of data.  All bounds are on the safe side of rounding, so the
    result is exact whatever the pivots.

    Rows with a null id, a null vector or null or non-finite components take
    no part; shorter vectors are padded with zeros, an empty one scores 0.
    Ties go to the smaller vec_id.  A row is not its own neighbour, but other
    rows with its id are; repeated query rows are answered each.  Scores are
    exact below 2^53 and rounded beyond, at most the largest long.
    """
    usable = F.expr("vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT exists(embedding, "
                    "x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query"))
            .filter(usable).select(F.monotonically_increasing_id().alias("row"), "vec_id", "is_query", "embedding"))
    dim = max(1, rows.agg(F.max(F.size("embedding"))).first()[0] or 0)
    sample = rows.orderBy(F.xxhash64(F.lit(grid.seed), "vec_id"), "vec_id").limit(grid.pivots).select("embedding").collect()
    pivots = np.zeros((max(1, len(sample)), dim))
    for p, r in zip(pivots, sample):
        p[:len(r[0])] = np.floor(grid.scale * np.asarray(r[0], dtype=np.float64))
    pivots = np.unique(pivots, axis=0)
    cells = stored(rows.mapInArrow(_assign(pivots, dim, grid.scale), "row long, vec_id long, is_query boolean, "
                                   "cell int, dist double, vec binary"), "cells")
    queries = cells.filter("is_query")

    n = len(pivots)
    high, low, norm = np.full((n, n), -np.inf), np.full((n, n), np.inf), np.zeros(n)
    for r in (queries.select("cell", "vec").mapInArrow(_query_summary(pivots), "i int, j int, high double, low double, norm double")
              .groupBy("i", "j").agg(F.max("high").alias("high"), F.min("low").alias("low"), F.max("norm").alias("norm")).collect()):
        high[r["i"], r["j"]], low[r["i"], r["j"]], norm[r["i"]] = r["high"], r["low"], r["norm"]
    near: list[list[float]] = [[] for _ in range(n)]
    order = W.partitionBy("cell").orderBy("dist", "row")
    for r in cells.select("cell", "dist", "row").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).collect():
        near[r["cell"]].append(r["dist"])
    used = np.isfinite(high).any(axis=1)
    bound = np.full(n, -np.inf)
    for i in np.flatnonzero(used):
        reached = sorted((low[i, j] - norm[i] * d for j in range(n) for d in near[j]), reverse=True)
        if len(reached) > k:
            bound[i] = reached[k] - 1e-6 * (1 + abs(reached[k]))  # k others beside the query itself
    with np.errstate(invalid="ignore"):
        need = np.where(used[:, None], bound[:, None] - high, np.inf)
    need = need - 1e-6 * (1 + np.abs(np.where(np.isfinite(need), need, 0)))

    # Query cells form groups around the mutually farthest of them.
    own = np.flatnonzero(used)
    seeds = own[:1].tolist()
    while len(seeds) < min(grid.groups, len(own)):
        d = np.min([((pivots[own] - pivots[s]) ** 2).sum(axis=1) for s in seeds], axis=0)
        seeds.append(int(own[d.argmax()]))
    group_of = np.argmin([((pivots - pivots[s]) ** 2).sum(axis=1) for s in seeds], axis=0) if seeds else np.zeros(n, dtype=int)
    group_of = np.where(used, group_of, -1)

    copies = cells.select("row", "vec_id", "cell", "dist", "vec").mapInArrow(
        _replicate(need, norm, group_of, len(seeds)), "grp int, row long, vec_id long, vec binary")
    asked = queries.withColumn("grp", F.element_at(F.array(*[F.lit(int(g)) for g in group_of]), F.col("cell") + 1))
    data_parts, query_parts = _parts(copies, grid.data_together), _parts(asked, grid.queries_together)
    if not query_parts or not data_parts:
        return cells.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                            F.lit(0).cast("long").alias("score")).limit(0)
    nd, nq = (_lookup({g: p.get(g, 1) for g in range(len(seeds))}) for p in (data_parts, query_parts))

    def every(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), parts - 1))

    cols = ["grp", "qp", "dp", "is_data", "row", "vec_id", "vec"]
    data = (copies.withColumn("dp", F.pmod(F.xxhash64("row"), nd).cast("int")).withColumn("qp", every(nq))
            .withColumn("is_data", F.lit(True)).select(*cols))
    ask = (asked.withColumn("qp", F.pmod(F.xxhash64("row"), nq).cast("int")).withColumn("dp", every(nd))
           .withColumn("is_data", F.lit(False)).select(*cols))
    met = (ask.unionByName(data).repartition("grp", "qp", "dp")
           .sortWithinPartitions("grp", "qp", "dp", "is_data", "vec_id"))
    found = met.mapInArrow(_solve(k, dim), "query_row long, query_id long, vec_id long, score long")
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
