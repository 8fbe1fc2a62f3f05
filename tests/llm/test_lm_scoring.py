import collections
import math
import zlib

import numpy as np

from orelake.llm import lm_scoring
from orelake.llm.lm_scoring import Mixture, learn_weights, lm_score
from tests.llm.helpers import empty, make, nasty, text

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    return (t or "").encode().translate(LOWER).split() + [None]


def fold(d):
    return zlib.crc32(str(d if d is not None else "").encode()) % 7


def rows_():
    return [r for r in nasty()] + [(100 + i, text(i % 37, 120, 300).upper() if i % 3 else text(i, 90, 80)) for i in range(150)]


def test_base_and_model_equal_a_plain_version(spark, monkeypatch):
    rows, seen = rows_(), {}
    real = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda *a, **k: seen.setdefault("w", real(*a, **k)))
    got = sorted((tuple(r) for r in lm_score(make(spark, rows), bucket_bytes=1 << 12).collect()), key=str)
    uni, bi = collections.Counter(), collections.Counter()
    for d, t in rows:
        if fold(d) != 2:
            w = tokens(t)
            uni.update(w)
            bi.update(zip(["start", *w], w))
    n, v = sum(uni.values()), len(uni)
    starts = uni[None]
    bucket = lambda c: 0 if c == 0 else min(47, 1 + int(math.log2(c)))
    want = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for a, b in zip(["start", *w], w):
            c = starts if a == "start" else uni[a]
            l2, l1, l0 = seen["w"][bucket(c)]
            score += math.log10(l2 * bi[a, b] / max(c, 1) + l1 * uni[b] / n + l0 / (v + 1))
        want.append((d, fold(d) == 2, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    want.sort(key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_better_than_the_base_on_held_out_texts(spark):
    got = lm_score(make(spark, [(i, chain(i)) for i in range(200)])).filter("held_out").collect()
    assert len(got) > 10 and sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)


def chain(seed, n=120):
    """A text in which the next word depends on the one before."""
    import random
    rng, w = random.Random(seed), 0
    out = []
    for _ in range(n):
        w = (3 * w + rng.randrange(4)) % 997 if rng.random() < 0.98 else rng.randrange(10**6)
        out.append(f"w{w}")
    return " ".join(out)


def test_weights_are_learned_by_bucket():
    cells = np.array([[3, 0.5, 0.01, 90], [3, 0.0, 0.01, 10], [5, 0.0, 0.1, 50], [5, 0.0, 0.0, 50]], dtype=float)
    w = learn_weights(cells, 1000)
    np.testing.assert_allclose(w.sum(axis=1), 1)
    assert w[3, 0] > 0.8 and w[5, 0] <= 2e-6 and w[5, 1] > 0.4 and (w > 0).all()
    assert np.allclose(w[10], w[0])                    # buckets without tokens share the pooled weights
    assert np.allclose(learn_weights(np.empty((0, 4)), 10), 1 / 3)


def test_every_text_has_a_finite_score():
    m = Mixture(10, 5, learn_weights(np.empty((0, 4)), 5))
    assert math.isfinite(m.score(np.array([0, 3]), np.array([0, 0])))


def test_empty_tables(spark):
    assert lm_score(empty(spark)).count() == 0
    only = lm_score(make(spark, [(i, None) for i in range(8)])).collect()
    assert all(math.isfinite(r.score) and r.n_tokens == 1 for r in only)
