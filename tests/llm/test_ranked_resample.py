import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelake.llm.ranked_resample import Splitters, ranked, regular_splitters, target_resample
from tests.llm.helpers import empty, make, nasty, text

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain(rows, target, percent=10, run=1, least=20, buckets=10_000):
    feats = lambda t: [" ".join(w[i:i + k]) for w in [words(t)] for k in range(1, run + 1) for i in range(len(w) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for r in rows for f in feats(r[1])), Counter(bucket(f) for x in target for f in feats(x))
    a, b = sum(s.values()), sum(t.values())
    gain = lambda i: math.floor(1000 * math.log((t[i] + 1) * (a + buckets) / ((s[i] + 1) * (b + buckets))))
    out = []
    for d, x in ((r[0], r[1]) for r in rows):
        f = feats(x)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain(bucket(i)) for i in f)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [i for i, r in enumerate(rows) if len(words(r[1])) >= least]
    able.sort(key=lambda i: (-out[i][3], (1 << 63) if out[i][0] is None else out[i][0]))
    for n, i in enumerate(able[:percent * len(able) // 100]):
        out[i][4] = n + 1
    return sorted(map(str, map(tuple, out)))


def run(spark, rows, target, **kw):
    t = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id long")
    return sorted(str(tuple(r)) for r in target_resample(make(spark, rows), t, **kw).collect())


def documents():
    return nasty() + [(i, text(i, 5 + i % 60)) for i in range(20, 420)]


TARGET = ["w1 W2 w3 " * 5, None, "", text(7, 300), "ärger Ünder w5-w6_w7"]


def test_equal_to_plain(spark):
    assert run(spark, documents(), TARGET) == plain(documents(), TARGET)


def test_longer_runs_and_small_segments(spark):
    assert run(spark, documents(), TARGET, run=2, percent=55, segment=9) == plain(documents(), TARGET, run=2, percent=55)


def test_repeated_rows_share_a_segment_border(spark):
    rows = [(5, "hot " * 25)] * 200 + [(i, text(i, 30)) for i in range(300)]
    assert run(spark, rows, TARGET, percent=60, segment=16) == plain(rows, TARGET, percent=60)


def test_empty_tables(spark):
    t = spark.createDataFrame([], "text string")
    assert target_resample(empty(spark), t).count() == 0
    assert run(spark, documents()[:30], []) == plain(documents()[:30], [])


@pytest.mark.parametrize("shape", ["ordered", "random", "equal"])
def test_no_segment_is_long_and_ranks_are_exact(spark, shape):
    n = 4000
    keys = {"ordered": np.arange(n), "random": np.random.default_rng(1).integers(0, 900, n), "equal": np.zeros(n, dtype=int)}[shape]
    rows = (spark.createDataFrame([(int(k), i % 50, i) for i, k in enumerate(keys)], "key__ long, doc__ long, i long").repartition(7)
            .sortWithinPartitions("key__", "doc__").withColumn("place__", F.monotonically_increasing_id()))
    cut, before = regular_splitters(rows.cache(), n, 100)
    assert max(np.diff([*before, n])) <= 200 and min(np.diff([*before, n])) >= 0
    got = {r.i: r.rank__ for r in ranked(rows, 1500, n, 100).collect()}
    order = [r.i for r in sorted(rows.collect(), key=lambda r: (r.key__, r.doc__, r.place__))]
    assert got == {i: r + 1 if r < 1500 else None for r, i in enumerate(order)}


def test_segments_of_equal_keys():
    cut = Splitters([(1, 2, 3), (1, 2, 9), (1, 5, 0), (4, 0, 0)])
    rows = [(0, 9, 9), (1, 2, 2), (1, 2, 3), (1, 2, 8), (1, 2, 9), (1, 4, 0), (1, 5, 0), (1, 6, 0), (3, 0, 0), (4, 0, 0), (5, 0, 0)]
    got = cut.segment(*[np.array(c) for c in zip(*rows)])
    assert got.tolist() == [sum(t <= r for t in cut.triples) for r in rows]
