import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orelake.llm.threshold_clusters import CentroidLists, cluster


def plain(rows, k, rounds, dims):
    v = [(i, [math.floor(256 * c) for c in x]) for i, x in rows
         if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x)]
    first = sorted(v, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cent = [x for _, x in first[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = {}
        for _, x in v:
            own.setdefault(near(x)[1], []).append(x)
        for j, xs in own.items():
            cent[j] = [sum(c) // len(xs) for c in zip(*xs)]
    got = [(i, *near(x)[::-1]) for i, x in v]
    size = {}
    for _, j, d in got:
        size[j] = size.get(j, 0) + d
    return sorted(str((i, j, d, size[j], sum(size.values()), hashlib.sha256(",".join(map(str, cent[j])).encode()).hexdigest()))
                  for i, j, d in got)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "cluster": F.lit("x"), "h": F.lit(0)})
    return sorted(str(tuple(r)) for r in cluster(df, **kw).drop("compared").collect())


def table():
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(i % 5, 0.4), 2) for _ in range(4)]) for i in range(400)]
    rows += [(3, rows[3][1])] * 150 + [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(40)]
    return rows + [(None, [0.5, 0.5, 0.5, 0.5]), (1, None), (2, []), (4, [1.0, 2.0, 3.0]), (5, [1.0, None, 2.0, 3.0]),
                   (6, [float("nan"), 0.0, 0.0, 0.0]), (7, [float("inf"), 0.0, 0.0, 0.0]), (8, [-0.001, 0.0, -3.25, 500000.5])]


def test_equal_to_plain(spark):
    assert run(spark, table(), k=12, rounds=4, dims=4) == plain(table(), 12, 4, 4)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = table()[:3]
    assert run(spark, rows, k=12, rounds=2, dims=4) == plain(rows, 12, 2, 4)
    assert run(spark, rows, dims=64) == []


def test_components_too_large_to_be_exact_raise(spark):
    with pytest.raises(Exception, match="2\\^27"):
        run(spark, [(1, [1e9, 0.0])], dims=2)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.integers(0, 10**6), st.integers(0, 3))
def test_walk_finds_the_nearest_and_the_smaller_of_equals(k, dims, seed, width):
    rng = np.random.default_rng(seed)
    cent, x = rng.integers(-width, width + 1, (k, dims)), rng.integers(-width - 2, width + 3, (40, dims))
    near, best, _ = CentroidLists(cent).assign(x)
    d = ((x[:, None, :] - cent[None]) ** 2).sum(axis=2)
    assert near.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()


def test_walk_leaves_out_centroids_that_are_far():
    cent = np.stack([np.arange(200) * 100, np.arange(200) * 100], axis=1)
    _, _, seen = CentroidLists(cent).assign(cent[50:60] + 3)
    assert seen.max() <= 3
