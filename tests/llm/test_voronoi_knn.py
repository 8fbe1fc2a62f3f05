import math
import random

from pyspark.sql import functions as F

from orelake.llm.voronoi_knn import Grid, knn_join


def plain(rows, k=5):
    v = []
    for n, (i, x) in enumerate(rows):
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v.append((n, i, [math.floor(256 * c) for c in x]))
    out = []
    for n, i, q in v:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for m, j, x in v if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"row": F.lit(1), "cell": F.lit("x"), "rank": F.lit(0)})
    return sorted(map(tuple, knn_join(df, F.col("vec_id") % 50 == 0, **kw).collect()))


def test_equal_to_all_pairs_with_ties_and_copies(spark):
    rng = random.Random(2)
    f = lambda x: __import__("struct").unpack("f", __import__("struct").pack("f", x))[0]
    rows = [(i, [f(rng.gauss(c := i % 4, 0.3)), f(rng.gauss(-c, 0.3)), f(rng.gauss(0, 1))]) for i in range(700)]
    rows += [(i, [1.0, -1.0, 0.5]) for i in range(700, 900)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, grid=Grid(pivots=7, groups=3, queries_together=4, data_together=60)) == plain(rows)


def test_odd_vectors(spark):
    rows = [(0, [0.5, 0.25]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]), (5, []),
            (6, [1.0]), (7, [-1.0, 2.0]), (None, [9.0, 9.0]), (50, []), (50, [0.1, 0.1]), (100, [0.0, 0.0])]
    assert run(spark, rows) == plain(rows)


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [1.0])]) == [(0, 1, 1, 65536)]
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, []) == []
